"""Company registration numbers (21 characters)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quorate.functions.text import strip

# Length and layout - listing letter, industry, state, year,
# company class, serial. The strict form wants L, U or F in front.
NUMBER_LENGTH = 21
STRICT_NUMBER = r"^[LUF]\d{5}[A-Z]{2}\d{4}[A-Z]{3}\d{6}$"
LOOSE_NUMBER = r"^[A-Z]{1,2}\d{5}[A-Z]{2}\d{4}[A-Z]{3}\d{6}$"


def normalise_number(number: Column) -> Column:
    return F.upper(strip(number.cast("string")))


def clean_number(number: Column) -> Column:
    """Normalised number when it has the strict layout, else null."""
    norm = normalise_number(number)
    return F.when((F.length(norm) == NUMBER_LENGTH) & norm.rlike(STRICT_NUMBER), norm)

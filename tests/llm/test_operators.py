"""The operators for training text: edge cases and brute force."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import re
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quorate.llm import bpe, decontaminate, exact_dedup, near_dedup, pii, quality, secrets, sharding, token_files, toxicity
from quorate.llm.queries import ORACLES, QUERIES

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id BIGINT, text STRING, `h` STRING, `n` INT, `row` STRING"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def table(spark, *rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "h", 1, "r") for i, t in rows], SCHEMA)


ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (5, "one TWO"), (None, "one two"), (None, None),
    (6, "É é \U0001f642 ﬁ  x\n \n y  "), (7, "word " * 30_000), (8, "a" * 60_000), (9, "'s I'll 12 ٣ ..!? <|endoftext|>"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, *ODD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, (1, "x")).limit(0)


@pytest.fixture(scope="module")
def texts(data):
    path = f"{data}/documents.parquet"
    return dict(duckdb.connect().execute(f"SELECT doc_id, text FROM '{path}'").fetchall())


def shape(rows):
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])


def labels(spark, n=40):
    return spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(n)] + [(None, 1, True), (3, None, None)], "doc_id BIGINT, quality INT, toxic BOOLEAN").withColumn("toxic", F.col("toxic").cast("int"))


def test_every_operator_takes_odd_rows_and_empty_tables(spark, odd, empty):
    items = spark.createDataFrame([("a", "one two"), ("b", None), (None, "word word")], "item_id STRING, text STRING")
    for work in (
        lambda d: exact_dedup.exact_dedup(d), lambda d: near_dedup.near_duplicates(d), lambda d: decontaminate.decontaminate(d, items),
        lambda d: secrets.scan_secrets(d), lambda d: sharding.shard_documents(d, 3), lambda d: pii.find_personal_data(d),
        lambda d: bpe.round_trip(d, RANKS, public_tokenizers.PATTERN), lambda d: token_files.token_files(d, WORDS),
        lambda d: quality.score_quality(d, labels(spark)), lambda d: toxicity.score_toxicity(d, labels(spark)),
    ):
        assert work(odd).count() == len(ODD)
        assert work(empty).count() == 0


def test_filters_keep_columns(spark, odd, empty):
    items = spark.createDataFrame([("a", "word word")], "item_id STRING, text STRING")
    for work in (
        exact_dedup.drop_copies, near_dedup.drop_near_copies, lambda d: decontaminate.drop_contaminated(d, items),
        lambda d: quality.keep_good(d, labels(spark)),
    ):
        assert work(odd).columns == odd.columns and work(empty).columns == odd.columns
        assert work(odd).count() > 0 and work(empty).count() == 0


def test_exact_dedup(odd):
    got = exact_dedup.exact_dedup(odd, keep="largest", fan_in=2).collect()
    groups = collections.defaultdict(list)
    for i, t in ODD:
        groups[lower(t)].append(i)
    assert sorted(r.text_sha256 for r in got) == sorted(hashlib.sha256(lower(t).encode()).hexdigest() for _, t in ODD)
    for text, ids in groups.items():
        own = [r for r in got if r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        assert {r.group_size for r in own} == {len(ids)} and sum(r.kept for r in own) == 1
        assert {r.keep_id for r in own} == {max(known)}
    least = {r.text_sha256: r.keep_id for r in exact_dedup.exact_dedup(odd).collect()}
    assert least[hashlib.sha256(b"one two").hexdigest()] == 4
    left = exact_dedup.drop_copies(odd).collect()
    assert len(left) == len(groups) and {r.doc_id for r in left} >= {1, 4}


def test_exact_dedup_merges_in_rounds(spark):
    rows = [(i, f"T{i % 7}" if i % 3 else "hot") for i in range(400)]
    got = exact_dedup.exact_dedup(table(spark, *rows).repartition(9), fan_in=2).collect()
    want = collections.Counter(lower(t) for _, t in rows)
    assert sum(r.kept for r in got) == len(want)
    assert {(r.keep_id, r.group_size) for r in got} == {(min(i for i, t in rows if lower(t) == k), n) for k, n in want.items()}


def test_byte_bpe_is_the_public_encoding(odd, texts):
    public = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
    coder = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(4)
    made = ["".join(rng.choice(" \n\t\xa0aAbé'sl!.1٣\U0001f642\x00 ") for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for t in [*texts.values(), *made, *(t or "" for _, t in ODD if len(t or "") < 50_000)]:
        ids = coder.encode([t])[0]
        assert np.frombuffer(ids, "<u4").tolist() == public.encode_ordinary(t) and coder.decode(ids) == t.encode()
    assert coder.encode(list(map(bytes.decode, filter(bytes.isascii, coder.tokens))))
    rows = bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(r.decoded_sha256 for r in rows) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in ODD)


def test_model_needs_whole_ranks():
    with pytest.raises(ValueError, match="gaps"):
        bpe.model_bytes({b"a": 0, b"b": 2})


def test_token_file_gives_any_token():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 2**32, 3000, dtype="u4"), rng.integers(0, 300, 3000, dtype="u4")])
    file = token_files.buffer(token_files.pack([4, None, 5], [6000, 0, 0], ids))
    assert file.documents()[0] == [4, None, 5] and (file.read(0, 6000) == ids).all()
    assert all(file.token(i) == ids[i] for i in range(0, 6000, 7)) and (file.read(4000, 900) == ids[4000:4900]).all()
    with pytest.raises(IndexError):
        file.read(5999, 2)
    nothing = token_files.buffer(token_files.pack([1], [0], np.zeros(0, "u4")))
    assert len(nothing.read(0, 0)) == 0


def test_token_files_hold_the_library_ids(spark, odd, texts, tmp_path):
    library = Tokenizer.from_file(WORDS)
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0]))
    got = token_files.token_files(odd, WORDS, folder=str(tmp_path / "t")).collect()
    got = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in order]
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in ODD if i is not None}
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
        if r.doc_id is not None:
            assert (r.n_tokens, r.ids_crc32) == (len(want[r.doc_id]), zlib.crc32(np.array(want[r.doc_id], "<u4").tobytes()))
    one = token_files.read_documents(spark, f"file://{tmp_path}/t", [4, 9])
    assert {i: v.tolist() for i, v in one.items()} == {i: want[i] for i in (4, 9)}
    coder = token_files.WordBpe(WORDS)
    sample = list(texts.values())[:60]
    assert coder.encode(sample) == coder._direct(sample)


def test_secret_spans_equal_the_patterns(spark, texts):
    made = [
        (10_001, 'é\U0001f642 Token = "abc_def=" AKIA' + "Z9" * 8 + " " + "0a" * 12 + " AKIA" + "Z" * 15),
        (10_002, "token=token:abcdefg api_key : 12345 APIKEY:'123456 " + "f" * 23), (10_003, None), (10_004, "secret" * 4000),
        (10_005, "see Qz7Rk2Xw9Lp4Vt8Ns3Yb and internationalisation_of_names"),
    ]
    rows = {**texts, **dict(made)}
    df = spark.createDataFrame(list(rows.items()), "doc_id BIGINT, text STRING")
    got = {r.doc_id: r for r in secrets.scan_secrets(df).collect()}
    for i, text in rows.items():
        spans = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "") if len(m[1]) > 5]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) > 19]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) > 23]
        want = [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]
        assert got[i].base_text == ",".join(want)
        assert [s for s in got[i].spans.split(",") if s and not s.startswith("random")] == want
    assert got[10_005].spans == "random:4:24"


def test_rare_secrets_are_counted(spark):
    """All labelled strings are in documents that come last by a hash of the id."""
    rng = random.Random(7)
    made = lambda: "".join(rng.choice("BCDFGHJKLMNPQRSTVWXZ23456789") for _ in range(40))
    ids = spark.range(21_000).withColumnRenamed("id", "doc_id")
    last = [r.doc_id for r in ids.orderBy(F.xxhash64("doc_id").desc()).limit(40).collect()]
    plain = F.lit("internationalisation understanding responsibilities communication development")
    labelled = [(i, " ".join(f"{k}={made()}" for k in ("token", "password", "secret", "api_key"))) for i in last]
    df = ids.where(~F.col("doc_id").isin(last)).select("doc_id", plain.alias("text")).union(spark.createDataFrame(labelled, "doc_id BIGINT, text STRING"))
    assert any(secrets.transition_ratios(df))


def brute_components(rows, k, similarity):
    sets = {}
    for i, t in rows:
        words = (t or "").encode().lower().split()
        n = min(k, len(words))
        sets[i] = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if words else set()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark, texts):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    base = [rng.choice(words) for _ in range(60)]
    rows = [(i, texts[i]) for i in list(texts)[:120]]
    for i in range(60):  # a chain of edits, so that links are not transitive
        base[rng.randrange(60)] = rng.choice(words)
        rows.append((5000 + i, " ".join(base)))
    rows += [(9000, None), (9001, ""), (9002, "one"), (9003, "ONE"), (9004, "one two")]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, k=2).collect()}
    assert got == brute_components(rows, 2, 80)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 1200, dtype="u8")
    a, b = np.sort(pool[:1000]), np.sort(pool[200:])
    share = np.mean(near_dedup.signature(a) == near_dedup.signature(b))
    assert abs(share - 800 / 1200) < 0.15 and len(near_dedup.bands(near_dedup.signature(a))) == near_dedup.BANDS
    pieces = near_dedup.signature(rng.integers(0, 2**63, 3 * near_dedup.PIECE, dtype="u8"))
    assert len(pieces) == 2 * near_dedup.PERMUTATIONS


def test_decontamination_finds_windows(spark):
    item = " ".join(f"w{i}" for i in range(14))
    items = spark.createDataFrame([(1, item), (2, "two words"), (3, None), (4, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 zz")], "item_id BIGINT, text STRING")
    docs = table(
        spark, (1, "a, W0 w1-w2 w3 w4 w5 w6 w7 w8 w9 b"), (2, "w0 w1 w2 w3 w4 w5 w6 w7 w8"), (3, item + " x " + item), (4, "two  words two words"),
        (5, "two"), (6, None), (7, "w4 w5 w6 w7 w8 w9 w10 w11 w12 w13"),
    )
    got = {r.doc_id: (r.n_words, r.n_hit, r.items, r.contaminated) for r in decontaminate.decontaminate(docs, items).collect()}
    assert got == {
        1: (12, 10, ["1"], True), 2: (9, 0, [], False), 3: (29, 28, ["1", "4"], True), 4: (4, 4, ["2"], True),
        5: (1, 0, [], False), 6: (0, 0, [], False), 7: (10, 10, ["1"], True),
    }
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()} == {2, 5, 6}
    assert not decontaminate.decontaminate(docs, items.limit(0)).where("contaminated").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, name):
    connection = duckdb.connect()
    for t in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    got = QUERIES[name](spark, data)
    result = connection.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(result.fetchall())


def test_shards_are_even_and_slots_gapless(spark, data, texts):
    got = QUERIES["op7_sharding"](spark, data).toPandas()
    assert len(got) == len(texts)
    for r in got.itertuples():
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    hot = table(spark, *[(i, "copy " * 50 if i % 3 else f"text {i} " * (i % 40)) for i in range(3000)])
    loads = sharding.shard_documents(hot, 8).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n")).toPandas()
    assert len(loads) == 8 and loads.b.max() < 1.02 * loads.b.mean() and loads.n.max() < 1.2 * loads.n.mean()


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_groups_stay_whole(spark, size):
    """Equal texts are in one shard, but for groups larger than a shard."""
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    placed = sharding.shard_documents(docs, 40).toPandas()
    texts = docs.toPandas().set_index("doc_id").text.fillna("")
    placed["text"] = placed.doc_id.map(texts)
    groups = placed.groupby("text").agg(parts=("shard", "nunique"), rows=("shard", "size"), bytes=("size", "sum"))
    large = (groups.bytes > placed["size"].sum() / 40) | (groups.rows > len(placed) / 40)
    assert (groups.rows > 1).any() and (groups.parts[~large] == 1).all()
    if size == "sf0.01":
        loads = placed.groupby("shard")["size"].sum()
        assert loads.max() < 1.01 * loads.mean() and loads.min() > 0.99 * loads.mean()


def test_packing_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    vectors = rng.integers(1, 100, (300, 3)).astype("f8")
    scaled = vectors / vectors.sum(0) * 7
    room, want = [[1.0] * 3 for _ in range(7)], {}
    for row in sorted(range(300), key=lambda r: (-max(scaled[r]), r)):
        products = [sum(a * b for a, b in zip(scaled[row], r)) for r in room]
        best = products.index(max(products))
        want[row] = best
        room[best] = [a - b for a, b in zip(room[best], scaled[row])]
    assert sharding.pack(vectors, 7).tolist() == [want[r] for r in range(300)]


def test_packing_prefers_the_best_dot_product():
    places = sharding.pack(np.array([[10.0, 0], [0, 10.0], [10.0, 0], [0, 10.0]]), 2)
    assert places[0] != places[2] and places[1] != places[3]


def luhn(digits):
    total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(digits[::-1]))
    return total % 10 == 0


def base_by_patterns(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) < 256 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        out += [(m.start(), 2, m.end())] if 12 <= len(digits) <= 19 and luhn(digits) else []
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_personal_data_equals_the_patterns(spark, texts):
    rng = random.Random(5)
    made = ["".join(rng.choice("a1.@-+ 9(%5b") for _ in range(rng.randint(0, 40))) for _ in range(20_000)]
    for t in [*texts.values(), *made, "9" * 5000, "a" * 5000 + "@", "x@y.z@w.v_q@r.s"]:
        assert sorted((a, k, b) for a, k, b, ok in pii.base_spans(t) if ok) == base_by_patterns(t)
    got = QUERIES["op9_personal_data"](spark, str("/root/testdata/sf0.001")).collect()
    for r in got:
        want = [f"{pii.NAMES[k]}:{a}:{b}" for a, k, b in base_by_patterns(texts[r.doc_id] or "")]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest() and set(want) <= set(filter(None, r.spans.split(",")))


def test_written_out_personal_data_is_added(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(3, 8)))
    text = lambda v: f"{word()} {word()} {v} {word()} {word()}"
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    values = [f"{word()}.{digits(2)}@{word()}.example.com" for _ in range(400)] + [f"+1 ({digits(3)}) 555-{digits(4)}" for _ in range(400)]
    rows = [(i, text(v)) for i, v in enumerate(values)]
    asked = {10_001: "alice (at) mail dot org", 10_002: "(212) 555-7713", 10_003: "4.18.12.905", 10_004: "2021-03-04 11", 10_005: "seen at example.com"}
    rows += [(i, f"one two {v} three") for i, v in asked.items()]
    got = {r.doc_id: r.spans for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert got[10_001] == f"address:8:{8 + len(asked[10_001])}" and got[10_002] == f"digits:8:{8 + len(asked[10_002])}"
    assert [got[i] for i in (10_003, 10_004, 10_005)] == ["", "", ""]


def test_trees_learn_a_rule():
    rng = np.random.default_rng(3)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.7)).astype(float)
    model = pii.fit(x, y, np.zeros(2000, int))
    assert np.mean((model.probabilities(x) > 0.5) == y) > 0.95 and 0 in model.thresholds


def auc(score, label):
    rank = np.argsort(np.argsort(score))
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def test_scores_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    known = duckdb.connect().execute(f"SELECT doc_id, quality, toxic FROM '{folder}/labels.parquet'").df().set_index("doc_id")
    for name, column in (("op1_quality", "quality"), ("op8_toxicity", "toxic")):
        got = QUERIES[name](spark, folder).toPandas().set_index("doc_id").join(known, how="inner")
        assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index]).all()
        own = got[got.held_out]
        assert auc(own.score.to_numpy(), own[column].to_numpy()) > 0.7 and got.score.between(0, 1).all()


def test_toxic_texts_are_found_in_every_language(spark):
    folder = "/root/testdata/sf0.1"
    known = duckdb.connect().execute(f"SELECT doc_id, lang, toxic FROM '{folder}/labels.parquet' JOIN '{folder}/documents.parquet' USING (doc_id)").df().set_index("doc_id")
    got = QUERIES["op8_toxicity"](spark, folder).toPandas().set_index("doc_id").join(known, how="inner")
    own = got[got.held_out & got.toxic.notna()]
    found = own[own.toxic == 1].groupby("lang").predicted.mean()
    assert set(found.index) == {"en", "de", "es", "fr"} and found.min() >= 0.75
    assert own[own.toxic == 0].predicted.mean() < 0.02


def test_rare_words_of_a_stem_count(spark):
    """No toxic word is in two confirmed texts; their stem is in all."""
    def text(i):
        bad = [f"grumbl{chr(97 + i % 26)}{chr(97 + i // 26)}{c}" for c in "abc"] if i % 2 else []
        return " ".join([*bad, *(f"plain{i * j % 97}" for j in range(1, 20))])

    df = table(spark, *[(i, text(i)) for i in range(400)])
    known = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id BIGINT, toxic INT")
    got = {r.doc_id: r.predicted for r in toxicity.score_toxicity(df, known).collect()}
    assert all(got[i] == i % 2 for i in range(300, 400))


def test_label_noise_is_no_input(spark):
    """A score depends on the text alone."""
    df = table(spark, *[(i, "bad %%% ***" if i % 2 else "plain words here and there") for i in range(200)])
    known = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(200)], "doc_id BIGINT, quality INT, toxic INT")
    for got, kind in ((quality.score_quality(df, known), 0), (toxicity.score_toxicity(df, known), 1)):
        scores = {r.doc_id: r.score for r in got.collect()}
        assert len({round(s, 9) for s in scores.values()}) == 2 and (scores[1] > scores[0]) == bool(kind)


def test_rank_files_are_what_they_say():
    assert bpe._field(2, 1.0) == b"\x15" + struct.pack("<f", 1.0) and base64.b64decode(b"YQ==") in bpe.read_ranks(RANKS)


def test_rows_of_one_id_are_one_set(spark, monkeypatch):
    """Two near equal texts, many rows each, all without an id: one set for
    each text reaches the comparison."""
    words = " ".join(f"w{i}" for i in range(60))
    docs = table(spark, *[(None, words if i % 2 else words + " more") for i in range(300)])
    seen, stage = {}, near_dedup.Stage.__call__

    def counting(self, df, name):
        out = stage(self, df, name)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(near_dedup.Stage, "__call__", counting)
    assert near_dedup.drop_near_copies(docs.repartition(4)).count() == 1
    assert seen["sets"] == 2 and seen["star-links"] == 1


def test_copies_are_dropped_by_place(spark):
    rows = [(None, "a")] * 3 + [(1, "b"), (1, "b"), (1, "c"), (0, "B"), (None, None), (5, "")]
    left = exact_dedup.drop_copies(table(spark, *rows).repartition(3)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in left) == [(False, 0, "B"), (False, 1, "c"), (False, 5, ""), (True, 0, "a")]
    assert left[0].h == "h"


def test_a_round_merges_sorted_runs(spark):
    """One exchange by run and range, one sort, and aggregates that need no
    sort or exchange of their own."""
    fields = "run INT, `range` INT, digest BINARY, n_bytes INT, check_hash BIGINT, best STRUCT<rank: BOOLEAN, id: BIGINT, place: BIGINT>, n BIGINT"
    entries = spark.createDataFrame([(r, 0, b"x", 1, 1, (False, r, r), 1) for r in range(4)], fields)
    round_ = exact_dedup.merged(entries, 2, F.min)
    assert {(r.run, r.best.id, r.n) for r in round_.collect()} == {(0, 0, 2), (1, 2, 2)}
    plan = round_._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("- Sort [") == 1 and "SortAggregate" in plan


def test_text_ids_stay_text(spark):
    docs = spark.createDataFrame([("k1", "one two three. token=abcdefg"), ("k2", "one two three. token=abcdefg"), (None, None)], "doc_id STRING, text STRING")
    none = labels(spark).limit(0).withColumn("doc_id", F.col("doc_id").cast("string"))
    for work in (
        lambda d: bpe.round_trip(d, RANKS, public_tokenizers.PATTERN), pii.find_personal_data, near_dedup.near_duplicates,
        lambda d: quality.score_quality(d, none), lambda d: toxicity.score_toxicity(d, none), exact_dedup.exact_dedup, sharding.shard_documents,
    ):
        assert sorted(map(str, (r.doc_id for r in work(docs).collect()))) == ["None", "k1", "k2"]
    assert {r.component_id for r in near_dedup.near_duplicates(docs).collect() if r.doc_id} == {"k1"}
    assert near_dedup.drop_near_copies(docs).count() == 2

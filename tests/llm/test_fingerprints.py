import hashlib

import corpus
import xxhash
from pyspark.sql import functions as F

from jornada.llm import fingerprints as P


def test_estimates_are_near_the_true_similarity(spark):
    base = corpus.sentence(400, 1).split()
    rows = []
    for share in range(0, 400, 20):
        rows.append((" ".join(base), " ".join(base[:share] + corpus.sentence(400 - share, share + 2).split())))
    frame = spark.createDataFrame(rows, "a string, b string")
    near = P.likeness(P.fingerprint(F.col("a")), P.fingerprint(F.col("b")))
    for row in frame.select("a", "b", near.alias("near")).collect():
        a, b = corpus.shingles(row["a"]), corpus.shingles(row["b"])
        assert abs(row["near"] - len(a & b) / len(a | b)) < 0.13


def test_unbiased_for_short_texts_that_need_densification(spark):
    rows = []
    for i in range(200):
        own = corpus.sentence(14, i).split()
        rows.append((" ".join(own), " ".join(own[:12] + ["x", "y"])))
    frame = spark.createDataFrame(rows, "a string, b string")
    near = P.likeness(P.fingerprint(F.col("a")), P.fingerprint(F.col("b")))
    mean = frame.select(F.avg(near)).first()[0]
    # 8 of 12 shingles are common.
    assert abs(mean - 8 / 12) < 0.05


def test_size_and_determinism(spark, docs):
    told = docs.select("text", P.fingerprint(F.col("text"), 128, 4).alias("p"), P.as_text(P.fingerprint(F.col("text"), 128, 4)).alias("t"))
    by_text = {}
    for r in told.collect():
        has = bool(corpus.words(r["text"]))
        assert (r["p"] is not None) == has and len(r["t"]) == (128 if has else 0)
        assert by_text.setdefault(r["text"], r["t"]) == r["t"]


def chained(*values):
    """The 64-bit hash of several values, each the seed of the next."""
    seed = 42
    for value in values:
        data = value if isinstance(value, bytes) else value[0].to_bytes(value[1], "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_print(text, bins=256, bits=8):
    """One-permutation MinHash with optimal densification, bin by bin."""
    own = (text or "").encode().lower().split()
    if not own:
        return ""
    shift = 63 - (bins.bit_length() - 1)
    hashes = [chained(*own[i : i + 5]) >> 1 for i in range(len(own) - 4)] if len(own) >= 5 else [chained(*own) >> 1]
    least = {}
    for h in hashes:
        least[h >> shift] = min(h, least.get(h >> shift, h))
    found = []
    for i in range(bins):
        value = least.get(i)
        for t in range(P.PROBES):
            if value is None:
                value = least.get(signed(chained((i, 4), (t, 4))) % bins)
        if value is None:
            value = min((signed(chained((i, 4), (b, 8))), h) for b, h in least.items())[1]
        found.append(value & ((1 << bits) - 1))
    whole = 0
    for value in found:
        whole = whole << bits | value
    return f"{whole:0{bins * bits // 4}X}"


def test_bits_equal_a_plain_version(docs):
    told = docs.select("text", P.as_text(P.fingerprint(F.col("text"))).alias("a"), P.as_text(P.fingerprint(F.col("text"), 128, 4)).alias("b"))
    rows = [r for r in told.collect() if len(r["text"] or "") < 20_000]
    assert len(rows) > 200
    for r in rows:
        assert r["a"] == plain_print(r["text"]), r["text"]
        assert r["b"] == plain_print(r["text"], 128, 4), r["text"]


def test_next_document_and_edited_text(spark, docs, none, conf):
    conf(spark__sql__shuffle__partitions="3")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    got = P.fingerprint_documents(docs).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    unique = {i for i, _ in rows if i is not None and sum(i == j for j, _ in rows) == 1}
    expected = {}
    for place, (i, text) in enumerate(order):
        following = order[(place + 1) % len(order)]
        half = len(text) // 2
        expected[i] = text[: len(text) - half] + following[1][:half]
    seen = 0
    for r in got:
        # The rows without id have no order that a plain version could repeat, nor has the one before them.
        if r["doc_id"] in unique and r["doc_id"] != min(unique):
            assert r["edited"] == expected[r["doc_id"]], r["doc_id"]
            assert r["n_chars"] == len(dict(rows)[r["doc_id"]])
            seen += 1
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert seen > 150
    assert P.fingerprint_documents(none).count() == 0


def test_last_document_is_followed_by_the_first(spark):
    one = corpus.frame(spark, [(5, "abcdef", "s")])
    assert P.fingerprint_documents(one).first()["edited"] == "abcabc"
    three = corpus.frame(spark, [(1, "aaaa", "s"), (2, "bbbbb", "s"), (3, "c", "s")])
    got = {r["doc_id"]: r["edited"] for r in P.fingerprint_documents(three).collect()}
    assert got == {3: "c", 2: "bbbaa", 1: "aac"}


def test_many_ranges_give_the_same_links(spark):
    docs = corpus.frame(spark, [(i * i, f"t{i}", "s") for i in range(200)]).select("doc_id", "text")
    for ranges in (1, 2, 7, 64):
        got = {r["doc_id"]: r["next_text"] for r in P.with_next(docs, ["text"], ranges).collect()}
        assert got == {i * i: f"t{(i - 1) % 200}" for i in range(200)}


def test_rows_without_id_and_of_one_id_are_cut_into_ranges(spark, conf):
    from jornada.llm.lm_scoring import word_number

    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = [(None if i % 3 == 0 else 77 if i % 3 == 1 else i, f"t{i}", "s") for i in range(600)]
    docs = corpus.frame(spark, rows).select("doc_id", "text")
    order = sorted(((i, t) for i, t, _ in rows), key=lambda r: (r[0] is None, -(r[0] or 0), word_number(r[1].encode())))
    expected = {t: order[(n + 1) % 600][1] for n, (_, t) in enumerate(order)}
    got = P.with_next(docs, ["text"], 16)
    assert {r["text"]: r["next_text"] for r in got.collect()} == expected
    # No window holds the rows of one id, or of none, together.
    ranges = got.select("doc_id", F.spark_partition_id()).distinct().groupBy("doc_id").count().where("doc_id is null or doc_id = 77")
    assert all(r["count"] > 1 for r in ranges.collect())


def test_sha_of_query(spark):
    assert hashlib.sha256("é".encode()).hexdigest() == spark.range(1).select(F.sha2(F.lit("é"), 256)).first()[0]

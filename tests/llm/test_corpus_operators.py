"""Mixing, long repeats, WARC, the shingle join, neighbours and the pipeline: against brute force on small tables."""

import hashlib
import io
import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from velograph.llm import long_repeats, mixing, ngram_join, registry, words
from velograph.llm.permutation_index import PermutationIndex, cosine, matrix
from velograph.llm.runindex import long_matches
from velograph.llm.warc import Members, base32_sha1, compress, read_warc, record_bytes, write_warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string"


# --- mixing ---------------------------------------------------------------------------------------------------------------


def sized(spark, n):
    r = random.Random(8)
    return spark.createDataFrame([(i, r.choice(["big"] * 8 + ["small", None]), r.randint(1, 30)) for i in range(n)], "doc_id long, source string, words long")


def test_least_budget_keeps_every_document_and_the_limit(spark):
    rows = sized(spark, 600)
    got = mixing.mix(rows, block_tokens=500, max_repeats=2.5, tokens=F.col("words"))
    counts = [r["count"] for r in got.groupBy("doc_id").count().collect()]
    assert len(counts) == 600 and max(counts) <= 3 and max(counts) > 1
    total = {r["source"]: r["t"] for r in got.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    once = {r["source"]: r["t"] for r in rows.groupBy("source").agg(F.sum("words").alias("t")).collect()}
    assert total["big"] == once["big"] and all(total[s] <= 2.5 * once[s] + 1 for s in once)


def test_budget_blocks_and_entropy(spark):
    rows = sized(spark, 800).union(sized(spark, 3))
    got = mixing.mix(rows, block_tokens=400, budget_share=0.5, entropy_share=0.9, tokens=F.col("words"))
    total = rows.agg(F.sum("words")).first()[0]
    spent = got.groupBy("source").agg(F.sum("tokens").alias("t")).toPandas()
    p = spent["t"] / spent["t"].sum()
    assert spent["t"].sum() <= 0.5 * total and -(p * np.log(p)).sum() == pytest.approx(0.9 * np.log(3), abs=0.05)
    place = got.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("place").alias("m"), F.sum("tokens").alias("t")).collect()
    assert all(r["m"] == r["n"] - 1 and r["t"] < 500 for r in place)
    assert mixing.mix(rows.filter("false"), tokens=F.col("words")).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(rows.withColumn("epoch", F.lit(0)), tokens=F.col("words"))


def test_streams_are_written_in_order_with_whole_rows(spark, tmp_path):
    """From a table in files, and from one that isn't: the same blocks, each in one file, files in the order of blocks; twins stay twins."""
    r = random.Random(9)
    rows = [(i, r.choice(["big", "big", "small", None]), "w " * r.randint(1, 40), {"k": i}) for i in range(400)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, source string, text string, extra map<string,long>")
    df.repartition(5).write.parquet(f"{tmp_path}/docs")
    read = spark.read.parquet(f"{tmp_path}/docs")
    plain = lambda d: sorted((x["doc_id"], x["epoch"], x["block"], x["place"], x["text"], x["extra"]["k"]) for x in d.collect())
    made = [mixing.mix(d, block_tokens=700, max_repeats=2.0, in_order=True) for d in (df, read, read.filter("doc_id >= 0"))]
    assert plain(made[0]) == plain(made[1]) == plain(made[2]) and made[1].columns == [*df.columns, *mixing.OWN]
    assert all(x["text"] == rows[x["doc_id"]][2] and x["extra"]["k"] == x["doc_id"] for x in made[1].collect())
    made[1].write.parquet(f"{tmp_path}/out")
    stream = []
    for f in sorted((tmp_path / "out").glob("*.parquet")):
        stream += [(x["block"], x["place"]) for x in pq.read_table(f, columns=["block", "place"]).to_pylist()]
    assert stream == sorted(stream) and len({b for b, _ in stream}) > 8


def test_words_are_counted_as_one_character_each(spark):
    texts = ["", None, "  ", "a", " a  b\n", "a\tb\x0bc d"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(mixing.token_count().alias("n")).collect()
    assert [r["n"] for r in rows] == [1, 1, 1, 1, 2, 4]


# --- long repeats -----------------------------------------------------------------------------------------------------------


def test_statistics_equal_brute_force():
    r = random.Random(3)
    for _ in range(120):
        length, letters = r.choice([3, 9, 17, 40]), r.choice(["a", "ab", "abcd"])
        base = ["".join(r.choice(letters) for _ in range(r.randint(0, 120))) for _ in range(3)]
        texts = [(x := r.choice(base))[: (i := r.randint(0, len(x)))].encode() + x[i + r.randint(0, 1) :].encode() for _ in range(r.randint(1, 8))]
        count: dict = {}
        for t in texts:
            for i in range(len(t) - length + 1):
                count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
        want = [[i + length <= len(t) and count[t[i : i + length]] > 1 for i in range(len(t))] for t in texts]
        assert [x.tolist() for x in long_matches(texts, length)] == want


def brute_cut(texts, n=400):
    count: dict = {}
    raw = [(t or "").encode() for t in texts]
    for b in raw:
        for i in range(len(b) - n + 1):
            h = hash(b[i : i + n])
            count[h] = count.get(h, 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if count[hash(b[i : i + n])] > 1:
                gone[i : i + n] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [2, 2048])
def test_cut_equals_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(long_repeats, "HOT", hot)
    r = random.Random(6)
    prose = lambda n: "".join(r.choice("abcdé fgh\n") for _ in range(n))
    passage, doc = prose(520), prose(1500)
    texts = ["", None, "x" * 399, "y" * 900, doc, doc, doc[:700] + "Z" + doc[700:], prose(3000), *[prose(r.randint(0, 300)) + passage + prose(r.randint(0, 300)) for _ in range(9)], passage[:399], "ab" * 600, prose(450) * 2]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], DOCS)
    rows = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in long_repeats.cut_digests(df).collect()}
    assert [rows[i] for i in range(len(texts))] == brute_cut(texts)
    kept = {x["doc_id"]: bytes(x["kept"]) for x in long_repeats.cut(df).collect()}
    assert hashlib.sha256(kept[6]).hexdigest() == rows[6][3] and kept[4] == b""


def brute_passages(texts, n=50):
    count: dict = {}
    lists = [(t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split() for t in texts]
    for w in lists:
        for i in range(len(w) - n + 1):
            count[tuple(w[i : i + n])] = count.get(tuple(w[i : i + n]), 0) + 1
    out = []
    for w in lists:
        hit = np.zeros(len(w) + 1, int)
        for i in range(len(w) - n + 1):
            if count[tuple(w[i : i + n])] > 1:
                hit[i : i + n] = 1
        out.append((int(np.count_nonzero(np.diff(np.concatenate(([0], hit))) == 1)), int(hit.sum())))
    return out


@pytest.mark.parametrize("hot", [2, 2048])
def test_passages_equal_brute_force(spark, hot, monkeypatch):
    """Passages of 50 words and more, shorter than 400 bytes, within other text, in one text twice, and none of 49 words."""
    monkeypatch.setattr(long_repeats, "HOT", hot)
    r = random.Random(12)
    prose = lambda n: " ".join("".join(r.choice("abcdé") for _ in range(r.randint(1, 6))) for _ in range(n))
    passage, short = prose(56), prose(49)
    texts = ["", None, *[f"{prose(r.randint(0, 90))} {passage.upper() if i == 3 else passage} {prose(r.randint(0, 90))}" for i in range(8)]]
    texts += [f"{prose(60)} {short}", f"{short}\n{prose(60)}", passage.replace(" ", "\n\t"), f"{prose(30)} {(x := prose(51))} {prose(3)} {x}", "la " * 300, "one two three " * 40, "x" * 900]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], DOCS)
    rows = {x["doc_id"]: (x["n_passages"], x["n_passage_words"]) for x in long_repeats.cut_digests(df).collect()}
    assert [rows[i] for i in range(len(texts))] == brute_passages(texts) and len(passage) < 400 and rows[10] == (0, 0) and rows[12] == (1, 56)


def test_a_text_that_repeats_itself_has_few_segments():
    for text in (b"y" * 200_000, b"ab" * 100_000):
        for window in (long_repeats.BYTES, long_repeats.WORDS):
            found = list(long_repeats.segments(long_repeats.symbols([text * (1 if window.width == 1 else 0) or b"y " * 100_000], window), window))
            assert sum(len(x[0]) for x in found) < 60 and sum(int(x[2].sum()) for x in found) == (200_000 if window.width == 1 else 100_000) - window.length + 1


def test_texts_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(long_repeats, "PIECE", 1000)
    r = random.Random(7)
    a = "".join(r.choice("abcdefgh ") for _ in range(5000))
    df = spark.createDataFrame([(0, a, "s"), (1, a[1234:3456], "s"), (None, "short", "s")], DOCS)
    rows = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in long_repeats.cut_digests(df).collect()}
    assert [rows[0], rows[1], rows[None]] == brute_cut([a, a[1234:3456], "short"])
    assert long_repeats.cut(df.filter("false")).count() == 0


# --- WARC -------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("step", [64, 1000, 1 << 20])
def test_every_record_has_one_owner(step):
    members = [compress(record_bytes(i, f"http://x/{i}\r\nInjected: 1", os.urandom(40) * i, "D", None if i % 3 else 1, "2024-01-01T00:00:00Z"), 4) for i in range(50)]
    raw = b"".join(members)
    found = [at for s in range(0, len(raw), step) for at, _ in Members(io.BytesIO(raw), len(raw), s, min(s + step, len(raw)))]
    assert found == np.cumsum([0, *map(len, members)])[:-1].tolist()


def test_warc_round_trip(spark):
    rows = [(3, "u", "<p>é</p>"), (9, None, "<p>é</p>"), (5, "u", None), (6, "u", ""), (None, "u", "<p>é</p>"), (7, "u", "z" * 200000), (7, "u", "z" * 200000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("lang", F.lit("x"))
    got = read_warc(spark, write_warc(pages, file_bytes=300), split_bytes=128).collect()
    assert len(got) == len(rows)
    kind = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"], r["payload_bytes"]) for r in got)
    assert kind == sorted([(3, "revisit", 9, 9), (9, "response", None, 9), (5, "revisit", 6, 0), (6, "response", None, 0), (-1, "revisit", 9, 9), (7, "response", None, 200000), (7, "response", None, 200000)], key=lambda x: x)
    assert {r["payload_digest"] for r in got if r["page_id"] == 9} == {base32_sha1(hashlib.sha1("<p>é</p>".encode()).hexdigest())}
    assert bytes(next(r["payload"] for r in got if r["page_id"] == 9)).decode() == "<p>é</p>"
    assert read_warc(spark, write_warc(pages.filter("false"))).count() == 0


def test_archives_are_read_by_several_tasks_that_split_files(spark, tmp_path):
    """Some 300 MB in two files: more tasks than files, every record once."""
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.col("id").cast("string"), F.repeat(F.md5(F.col("id").cast("string")), 32_000)).alias("html"))
    manifest = write_warc(pages.coalesce(2), level=0)
    sizes = [r["n_bytes"] for r in manifest.collect()]
    assert len(sizes) == 2 and sum(sizes) > 300_000_000
    got = read_warc(spark, manifest, payloads=False)
    assert got.rdd.getNumPartitions() >= 9
    tasks = got.select("page_id", F.spark_partition_id().alias("t")).collect()
    assert sorted(r["page_id"] for r in tasks) == list(range(300)) and len({r["t"] for r in tasks}) >= 5


# --- shingle join -----------------------------------------------------------------------------------------------------------


def brute_classes(texts):
    sets = []
    for t in texts:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))
    top = lambda x: x if root[x] == x else top(root[x])
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), top(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("family", [4096, 2])
def test_classes_equal_brute_force(spark, family, monkeypatch):
    monkeypatch.setattr(ngram_join, "FAMILY_SETS", family)
    r = random.Random(11)
    words = [f"w{i}" for i in range(40)]
    texts = ["", None, "one", "ONE", "a b c d", "a b c D", "a b c d e"]
    for _ in range(12):
        base = [r.choice(words) for _ in range(r.randint(5, 120))]
        for _ in range(6):
            copy = list(base)
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = r.choice(words)
            texts.append(" ".join(copy).title() if r.random() < 0.3 else "\t".join(copy))
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], DOCS)
    rows = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.classes(df).collect()}
    want = brute_classes(texts)
    assert [rows[i] for i in range(len(texts))] == want
    kept = sorted(x["doc_id"] for x in ngram_join.keep_one(df).collect())
    assert kept == [i for i, (_, c) in enumerate(want) if c == i]


def test_members_of_families_are_linked_as_by_all_pairs():
    """Near copies, unlike sets with most of their tokens in common, and several families in one task."""
    r = np.random.default_rng(3)
    rare = np.zeros(1 << ngram_join.SKETCH_BITS, np.uint8)
    draw = lambda n: r.integers(0, 1 << 48, n, dtype=np.uint64)
    sets, family = [], []
    for f in range(6):
        common = [draw(60) for _ in range(2)]
        for _ in range(40):
            own = np.concatenate((common[r.integers(2)][: r.integers(30, 60)], draw(r.integers(1, 50))))
            sets += [np.unique(own), np.unique(np.concatenate((own[r.integers(0, 8) :], draw(r.integers(0, 4)))))]
            family += [f, f]
    found = ngram_join.link_members(np.array(family), sets, rare)
    assert all(ngram_join.similar(sets[a], sets[b]) and a < b for a, b in found)

    def parts(pairs):
        root = list(range(len(sets)))
        top = lambda x: x if root[x] == x else top(root[x])
        for a, b in pairs:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
        return [top(x) for x in root]

    every = [(a, b) for b in range(len(sets)) for a in range(b) if family[a] == family[b] and 4 * (m := len(np.intersect1d(sets[a], sets[b]))) >= 3 * (len(sets[a]) + len(sets[b]) - m)]
    assert parts(found) == parts(every) and 100 < len(found) == len(sets) - len(set(parts(every)))


def test_unlike_sets_with_common_tokens_cost_their_prefix_hits(monkeypatch):
    """Sixty of a hundred tokens are common, and counted as such: nothing is verified."""
    r = np.random.default_rng(5)
    rare = np.zeros(1 << ngram_join.SKETCH_BITS, np.uint8)
    common = r.integers(0, 1 << 48, 60, dtype=np.uint64)
    rare[(common >> np.uint64(48 - ngram_join.SKETCH_BITS)).astype(int)] = 24
    sets = [np.unique(np.concatenate((common, r.integers(0, 1 << 48, 40, dtype=np.uint64)))) for _ in range(1500)]
    tried = []
    monkeypatch.setattr(ngram_join, "similar", lambda a, b: tried.append(1))
    assert ngram_join.link_members(np.zeros(1500, int), sets, rare) == [] and len(tried) < 50


def test_hot_tokens_are_salted_and_keep_all_sets(spark):
    rows = [(40 << 56 | 5, s, 20, 0) for s in range(300)] + [(7, s, 20, 0) for s in range(3)]
    df = spark.createDataFrame(rows, "token long, sid long, n int, i int")
    got = ngram_join.buckets(df.union(df), hot=20).collect()
    assert sorted(r["sid"] for r in got if r["token"] != 7) == list(range(300)) and sorted(r["sid"] for r in got if r["token"] == 7) == [0, 1, 2]
    full = np.zeros(1 << ngram_join.SKETCH_BITS, np.uint8)
    assert ngram_join.hot_step(full) == 18 and ngram_join.hot_step(full + 20) == 28


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"x{i}" for i in range(30))
    df = spark.createDataFrame([(4, text, "a"), (4, text, "a"), (None, text, "a"), (4, "other words of this very row", "a"), (9, "", "a"), (9, "", "a")], DOCS)
    assert ngram_join.keep_one(df).count() == 3
    assert ngram_join.classes(df.filter("false")).count() == 0


def test_long_words_and_chunks(monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK", 50)
    monkeypatch.setattr(words, "CHUNK", 50)
    parts = [b"", b" a bc  d\n" * 40, b"q" * 900, b"\t", b"a bc d"]
    assert [x.tolist() for x in words.hash_each(parts)] == [words.word_hashes(x)[0].tolist() for x in parts]
    texts = ["q" * 70000 + " a b c d", "q" * 70001 + " a b c d", " a  b\nc\td e f", "a b c d e f", "x"]
    sets = ngram_join.shingle_sets(texts)
    assert sets[0].tolist() != sets[1].tolist() and sets[2].tolist() == sets[3].tolist() and [len(s) for s in sets] == [1, 1, 2, 2, 1]


# --- neighbours ---------------------------------------------------------------------------------------------------------------


def test_neighbours_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (5, [None, 1.0], 1), (6, [1.0, 0.1], 1), (7, [1.0, 2.0, 3.0], 1), (None, [1.0, 0.0], 1)]
    got = PermutationIndex(spark.createDataFrame(rows, schema)).search(F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 6)] and got[0]["score"] == pytest.approx(1 / np.sqrt(1.01))
    assert PermutationIndex(spark.createDataFrame([], schema)).search(F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("n", [6000, 24000])
def test_recall(spark, n):
    """At two sizes, of vectors without clusters; queries read a falling share of the rows."""
    r = np.random.default_rng(1)
    d = r.normal(size=(n, 48)).astype(np.float32).astype(float)
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(range(n), pa.int64()), "embedding": pa.array(list(d))}))
    index = PermutationIndex(df)
    asked = list(range(0, n, n // 60))
    got = {(x["query_id"], x["vec_id"]): x["score"] for x in index.search(F.col("vec_id").isin(asked)).collect()}
    assert len(got) == 5 * len(asked) and all(s == pytest.approx(float(cosine(d[q], d[v][None])[0]), abs=0) for (q, v), s in got.items())
    want = set()
    for q in asked:
        s = cosine(d[q], d)
        s[q] = -2
        want |= {(q, int(i)) for i in np.argsort(-s)[:5]}
    assert len(got.keys() & want) >= 0.9 * len(want)
    reads = {x["query_id"]: set(x["probes"]) for x in index.asked(F.col("vec_id").isin(asked)).collect()}
    posts = matrix(pa.array([x["posts"] for x in index.posted.select("posts").collect()]), int)
    share = np.mean([np.isin(posts, list(x)).any(axis=1).mean() for x in reads.values()])
    assert share < {6000: 1.0, 24000: 0.8}[n]


def test_equal_vectors_return_their_least_ids(spark):
    """Half of all rows are one vector: ties go to the smaller vec_id, whatever the order of rows."""
    r = np.random.default_rng(2)
    v = r.normal(size=(4001, 16)).astype(np.float32)
    v[1::2], v[0] = v[1], v[1]
    df = spark.createDataFrame(pa.table({"vec_id": pa.array(range(4001), pa.int64()), "embedding": pa.array(list(v.astype(float)))}))
    got = PermutationIndex(df).search(F.col("vec_id").isin(0, 7)).orderBy("query_id", "rank").collect()
    assert [x["vec_id"] for x in got] == [1, 3, 5, 7, 9, 0, 1, 3, 5, 9]


def test_copies_and_dense_clusters_lose_no_neighbour(spark):
    """A third equal rows, a third near copies, and repeated rows of one id, in any order of rows: as by brute force."""
    r = np.random.default_rng(4)
    v = r.normal(size=(1500, 24)).astype(np.float32)
    v[1::3] = v[1]
    v[2::3] = v[2] + 1e-3 * r.normal(size=(500, 24)).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    d = v.astype(float)
    want = []
    for q in range(0, 1500, 50):
        s = cosine(d[q], d)
        s[q] = -2
        want += [(q, k + 1, int(i), float(s[i])) for k, i in enumerate(np.lexsort((np.arange(1500), -s))[:5])]
    for order in (rows + rows[50:51] * 200, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<float>")
        got = sorted(tuple(x) for x in PermutationIndex(df).search(F.col("vec_id") % 50 == 0).collect())
        assert got == want


def test_a_run_passed_on_in_parts_keeps_all_sets(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LONG_RUN", 40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 59)
    try:
        # the last part of token 5 is one set
        rows = [(5, s, 20, 0) for s in range(60)] + [(3, s, 20, 0) for s in range(30)]
        got = ngram_join.buckets(spark.createDataFrame(rows[:60], "token long, sid long, n int, i int"))
        assert sorted(r["sid"] for r in got.collect()) == list(range(60))
        got = ngram_join.buckets(spark.createDataFrame(rows, "token long, sid long, n int, i int"))
        assert sorted(r["sid"] for r in got.filter("token = 5").collect()) == list(range(60))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# --- registered queries and the pipeline ----------------------------------------------------------------------------------------

needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = registry.queries()[name](spark, SF)
    want = con.sql(registry.oracle_sql()[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    plain = lambda rows, cols: sorted(tuple("" if r[cols.index(c)] is None else str(r[cols.index(c)]) for c in order) for r in rows)
    assert plain(df.collect(), df.columns) == plain(want.fetchall(), list(want.columns))


@needs_tables
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append((name, docs))
        if name != "tokens":
            assert docs.columns == columns
    by = dict(seen)
    ids = lambda name: {r["doc_id"] for r in by[name].collect()}
    assert ids("near_duplicates") < ids("toxicity") and ids("personal_data") == ids("near_duplicates") == ids("mixing") == ids("tokens")
    texts = [(r["doc_id"], r["text"]) for r in by["toxicity"].orderBy("doc_id").collect()]
    assert ids("near_duplicates") == {texts[i][0] for i, (_, c) in enumerate(brute_classes([t for _, t in texts])) if c == i}
    assert not by["personal_data"].filter(F.col("text").rlike(r"[a-z0-9]@[a-z0-9-]+\.[a-z]")).count()
    assert by["mixing"].count() == by["tokens"].count() >= by["personal_data"].count()
    assert {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SF).collect()} == {r["doc_id"]: r["n_tokens"] for r in by["tokens"].collect()}

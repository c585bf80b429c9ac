"""Every operator on nulls in any column, empty and very long texts, ties and repeated rows, empty tables, and columns whose names clash."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from velograph.llm import long_repeats, mixing, ngram_join, pii, quality, toxicity, unit_dedup
from velograph.llm.bpe import tokenize
from velograph.llm.permutation_index import PermutationIndex
from velograph.llm.q_bpe import vocabulary_path
from velograph.llm.warc import read_warc, write_warc

pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use within.
INNER = (
    "a", "anchor", "at", "base", "bq", "content", "copies", "d1", "digest", "file", "first", "found", "gone", "group", "h1", "held", "hits", "html", "id", "ids", "kept_sha256", "keeper", "key", "least", "m", "n",
    "name", "own", "page_id", "places", "quota", "r", "root", "row", "sid", "source_r", "source_rows", "source_tokens", "spans", "target", "terms", "token", "toxic", "url", "weight", "words",
    "__ahead", "__at", "__bucket", "__copy_", "__doc", "__starts", "__windows", "__hash", "__id", "__ids", "__k", "__key", "__name", "__order", "__own", "__row", "__source", "__sum", "__text",
)
#: Of each operator, the names that it adds to the rows it passes on, and therefore refuses.
REFUSED = {"mix": mixing.OWN, "cascade": ("n_words", "base_failed", "kept", "rejected_by")}


def rows():
    r = random.Random(4)
    prose = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 8))) for _ in range(n))
    shared = prose(120)
    texts = [None, "", " \n\t", "x", prose(40), shared, shared, f"{prose(30)} {shared}.", "é" * 3000, f"mail jan@corp.example.org or +48 123 456 789. {prose(20)}", "y " * 30_000, prose(60_000)]
    out = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    out += [(None, shared, None, None, None), (None, None, None, None, None), out[5], out[5], out[4], (4, texts[4], "en", "other", 1)]
    return out


def table(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def labels(spark):
    return spark.createDataFrame([(i, None if i == 3 else 1, None if i == 4 else int(i % 4 == 0)) for i in range(60)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")


def round_trip(df):
    pages = df.select(*[c for c in df.columns if c not in ("page_id", "url", "html")], F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))
    return read_warc(df.sparkSession, write_warc(pages))


def neighbours(df):
    vectors = df.drop("vec_id", "embedding").withColumns({"vec_id": F.col("doc_id"), "embedding": F.when(F.col("n_chars") > 2, F.array(F.col("n_chars").cast("double"), F.lit(1.0), F.col("doc_id").cast("double")))})
    return PermutationIndex(vectors).search(F.col("vec_id") % 2 == 0)


def judged(df):
    return quality.cascade(quality.measure(df), quality.plan_cascade(df))


OPERATORS = {
    "mix": lambda df: mixing.mix(df, block_tokens=500, max_repeats=2.0),
    "find": pii.find,
    "sanitise": pii.sanitise,
    "cut": long_repeats.cut_digests,
    "cascade": judged,
    "reject": lambda df: toxicity.reject(df, labels(df.sparkSession)),
    "score": lambda df: toxicity.score(df, toxicity.fit(df, labels(df.sparkSession))),
    "units": unit_dedup.dedup_units,
    "archive": round_trip,
    "tokens": lambda df: tokenize(df, vocabulary_path()),
    "classes": ngram_join.classes,
    "keep_one": ngram_join.keep_one,
    "neighbours": neighbours,
}
PASSES_ON = ("mix", "sanitise", "cascade", "reject", "keep_one")


def plain(df, columns):
    return sorted(str([r[c] for c in columns]) for r in df.select(*[F.col(f"`{c}`") for c in columns]).collect())


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names_change_nothing(spark, name):
    run, df = OPERATORS[name], table(spark)
    want = run(df)
    clash = df.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in INNER])
    got = run(clash)
    assert plain(got, want.columns) == plain(want, want.columns) != []
    if name in PASSES_ON:
        assert got.columns[: len(clash.columns)] == clash.columns
        for r in got.select("doc_id", *[F.col(c).alias(f"v{i}") for i, c in enumerate(INNER)]).collect():
            assert list(r[1:]) == [f"{c}:{'none' if r[0] is None else r[0]}" for c in INNER]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_and_the_order_of_rows(spark, name):
    run, df = OPERATORS[name], table(spark)
    assert run(df.filter("false")).collect() == []
    turned = spark.createDataFrame(rows()[::-1], SCHEMA)
    want = run(df)
    assert plain(run(turned), want.columns) == plain(want, want.columns)


@pytest.mark.parametrize(("name", "column"), [(n, c) for n, names in REFUSED.items() for c in names])
def test_names_of_results_are_refused(spark, name, column):
    with pytest.raises(ValueError, match=column):
        OPERATORS[name](table(spark).withColumn(column, F.lit(1)))


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_tables(spark, tmp_path, stage):
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    run, df = dict(corpus_pipeline.STAGES)[stage], table(spark)
    assert run(spark, df.filter("false"), str(tmp_path)).collect() == []
    clash = df.select("*", *[F.lit(c).alias(c) for c in INNER])
    a, b = run(spark, df, str(tmp_path)), run(spark, clash, str(tmp_path))
    assert plain(a, a.columns) == plain(b, a.columns) != []
    if stage != "tokens":
        assert a.columns == df.columns and b.columns == clash.columns

"""Line, paragraph and sentence hashing against a plain loop."""

import random
import re

import pytest

from velograph.llm import registry
from velograph.llm.unit_dedup import dedup_units, normalise

SCHEMA = "doc_id long, text string, source string"


def plain_dedup(texts, separator, least=1, sentence=8):
    """Two passes: what occurs how often and first where, then what goes."""
    units, count, first = [], {}, {}
    for d, t in enumerate(texts):
        at = 0
        for i, line in enumerate((t or "").split(separator)):
            parts = [x for x in re.split(r"(?<=[.!?])(?=[\x20\x09-\x0D])", line)]
            parts = [p for p in re.findall(r"(?s).*?[.!?][\x20\x09-\x0D]+|.+$", line)] if len(parts) > 1 else [line]
            own = [(d, i, 0, at, line)]
            if sum(bool(normalise(p)) for p in parts) > 1:
                pos = at
                for j, p in enumerate(parts, 1):
                    own.append((d, i, j, pos, p))
                    pos += len(p)
            for u in own:
                name = normalise(u[4])
                if name and len(name.split(" ")) >= (sentence if u[2] else least):
                    units.append((*u, name))
                    count[name] = count.get(name, 0) + 1
                    first.setdefault(name, u[:3])
            at += len(line) + len(separator)
    out = []
    for d, t in enumerate(texts):
        own = [u for u in units if u[0] == d]
        def outer(some):
            lines = {u[1] for u in some if not u[2]}
            return [u for u in some if not u[2] or u[1] not in lines]
        gone = outer([u for u in own if first[u[5]] != u[:3]])
        again = outer([u for u in own if count[u[5]] > 1])
        kept, lines = [], {u[1] for u in gone if not u[2]}
        at = 0
        for i, line in enumerate((t or "").split(separator)):
            if i not in lines:
                text = line
                for u in sorted((u for u in gone if u[1] == i), key=lambda u: -u[3]):
                    text = text[: u[3] - at] + text[u[3] - at + len(u[4]) :]
                kept.append(text)
            at += len(line) + len(separator)
        spans = sorted((u[3], u[3] + len(u[4])) for u in gone)
        # a text's smallest units in order, each with the words of the repeated unit that begins there; None breaks a run
        leaves, runs = [], [0]
        for line in sorted({u[1] for u in own}):
            inner = [u for u in own if u[1] == line and u[2]]
            whole = [u for u in again if u[1] == line and not u[2]]
            if whole:
                leaves += [len(whole[0][5].split(" "))] + [0] * (max(1, len(inner)) - 1)
            else:
                leaves += [len(u[5].split(" ")) if u in again else None for u in inner] or [None]
        for n in leaves:
            runs = [*runs, 0] if n is None else [*runs[:-1], runs[-1] + n]
        long = [n for n in runs if n >= 20]
        out.append((len(gone), ",".join(f"{s}:{e}" for s, e in spans), len(again), sum(len(u[5].split(" ")) for u in again), len(long), sum(long), separator.join(kept)))
    return out


@pytest.mark.parametrize("separator", ["\n", "\n\n"])
def test_units_equal_a_plain_loop(spark, separator):
    r = random.Random(5)
    words = lambda n: " ".join(r.choice("a B é word Line other x".split()) for _ in range(n))
    said = [words(r.randint(1, 14)) + r.choice([".", "!", "?!", ""]) for _ in range(40)]
    lines = [r.choice([" ", "  "]).join(r.choice(said) for _ in range(r.randint(1, 4))) + r.choice(["", " "]) for _ in range(40)]
    texts = ["", None, "\n\n\n", "Same words as in here", "same  WORDS\tas in here", "...", "a. . b.", *["\n".join(r.choice(lines) for _ in range(r.randint(1, 12))).replace("\n", r.choice(["\n", "\n\n"])) for _ in range(40)], "x " * 40000, "y. " * 30000]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA)
    names = ("n_removed", "spans", "n_repeated", "n_repeat_words", "n_passages", "n_passage_words", "kept")
    rows = {x["doc_id"]: tuple(x[n] for n in names) for x in dedup_units(df, separator).collect()}
    assert [rows[i] for i in range(len(texts))] == plain_dedup(texts, separator)


def test_a_passage_within_longer_lines_is_caught(spark):
    r = random.Random(8)
    prose = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))
    passage = " ".join(prose(11) + "." for _ in range(5))
    texts = [f"{prose(20)} {passage} {prose(20)}." for _ in range(3)] + [f"{prose(20)}. {prose(20)}." for _ in range(3)]
    rows = {x["doc_id"]: x for x in dedup_units(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert [rows[i]["n_removed"] for i in range(6)] == [0, 4, 4, 0, 0, 0] and [rows[i]["n_repeat_words"] for i in range(6)] == [44, 44, 44, 0, 0, 0]
    assert [(rows[i]["n_passages"], rows[i]["n_passage_words"]) for i in range(6)] == [(1, 44)] * 3 + [(0, 0)] * 3
    assert passage[60:] not in rows[1]["kept"] and rows[0]["kept"] == texts[0] and rows[4]["kept"] == texts[4]


def test_repeated_rows_null_ids_and_empty_tables(spark):
    line = "five words or more here"
    df = spark.createDataFrame([(3, line, "a"), (3, line, "a"), (None, line, "a"), (4, "short", "b")], SCHEMA)
    rows = sorted((str(x["doc_id"]), x["n_removed"], x["n_repeated"], x["kept"]) for x in dedup_units(df).collect())
    assert rows == [("3", 1, 1, ""), ("3", 1, 1, ""), ("4", 0, 0, "short"), ("None", 0, 1, line)]
    assert dedup_units(df.filter("false")).count() == 0


def test_short_lines_are_removed_too(spark, tmp_path):
    texts = ["All rights reserved.\n\nx\none line", "all  rights reserved.\n\nX\nother", "x"]
    spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: (r["n_removed"], r["spans"]) for r in registry.queries()["op6_line_hashing"](spark, str(tmp_path)).collect()}
    assert rows == {0: (0, ""), 1: (2, "0:21,23:24"), 2: (1, "0:1")}

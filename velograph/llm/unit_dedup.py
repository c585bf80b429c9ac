"""Removal of repeated lines (or paragraphs) and, within other lines, of repeated sentences, by hashing.

A text is split at a separator into lines. A line of several sentences is split further, after a full stop, an exclamation or a
question mark that white space follows; such sentences are units of their own from SENTENCE_WORDS words on, lines from
min_words words on. A unit is normalised (ASCII letters in lower case, runs of white space as one space, none at the ends) and
named by a 128-bit digest. Digests are grouped over the corpus; the occurrence that ranks first (doc_id, nulls first, then
text, then place) stays, and all others are removed from their texts, in the same document or in others. So a passage that is
repeated within longer lines loses its whole sentences. Removed units keep their offsets in the original text (code points,
end exclusive); a line goes with its separator, a sentence with the white space after it. A first occurrence is always
in a line that stays, so what ranks first doesn't hang on what is removed.

Beside that, every document's repeated units are counted, first occurrences included, and their words: documents that share a
passage show it, whichever of them keeps it. A sentence in a repeated line counts with its line. Repeated units with no other
unit between them are a run, and a run of PASSAGE_WORDS words or more is a passage: a passage of 50 words that stands within
longer lines is left with that many in whole sentences, while lines that many documents hold are mostly shorter and stand alone.

Only units, digests and the texts of documents that lose something are shuffled. Null texts are empty; rows equal in doc_id and
text are treated alike, so that a repeated row doesn't empty its twin (its units count as repeated); an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.llm.long_repeats import matching_rows, own_rows
from velograph.llm.shared import settle

MIN_WORDS, SENTENCE_WORDS, PASSAGE_WORDS = 1, 8, 20
SPACE = re.compile(r"[\x20\x09-\x0D]+")
SENTENCE_END = re.compile(r"[.!?][\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Units that a task holds before it passes them on.
UNITS_HELD = 20_000
#: A unit's place is its line, and its sentence from 1 (0: the line itself) in the lower bits.
SENTENCE_BITS = 32
#: leaf and leaves: the first of the sentences (or lines without such) that a unit holds, counted through the text, and how many.
UNITS = "doc_id long, key long, place long, leaf int, leaves int, words int, d1 long, d2 long"
COUNTS = ("n_repeated", "n_repeat_words", "n_passages", "n_passage_words")
ROW = ["doc_id", "key"]


def normalise(unit: str) -> str:
    return SPACE.sub(" ", unit).strip(" ").translate(UPPER)


def sentences(line: str) -> list[str]:
    """The line in parts that each end after a sentence and its white space."""
    out, at = [], 0
    for m in SENTENCE_END.finditer(line):
        out.append(line[at : m.end()])
        at = m.end()
    out.append(line[at:])
    return out


def unit_digests(text: str, separator: str, min_words: int, sentence_words: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """Place, leaf, leaves, words and digest of every unit."""
    leaf = 0
    for i, line in enumerate(text.split(separator)):
        parts = sentences(line)
        plain = [normalise(p) for p in parts] if len(parts) > 1 else []
        several = sum(map(bool, plain)) > 1
        own = [(j, u.count(" ") + 1, u) for j, u in enumerate([normalise(line), *(plain if several else ())]) if u]
        own = [x for x in own if x[1] >= (sentence_words if x[0] else min_words)]
        inner = sum(x[0] > 0 for x in own)
        before = 0
        for j, words, unit in own:
            yield i << SENTENCE_BITS | j, leaf + before, 1 if j else max(1, inner), words, hashlib.blake2b(unit.encode("utf-8", "replace"), digest_size=16).digest()
            before += j > 0
        leaf += max(1, inner) if own else 0


def name_units(docs: DataFrame, separator: str, min_words: int, sentence_words: int, text: str = "text") -> DataFrame:
    """UNITS of every document. Written out."""

    def part(b: pa.RecordBatch, rows: list[int], found: list[tuple]) -> pa.RecordBatch:
        at = pa.array(rows, pa.int32())
        places, leaf, leaves, words, names = zip(*found, strict=True) if found else ((),) * 5
        both = pa.array([int.from_bytes(n[k : k + 8], "little", signed=True) for k in (0, 8) for n in names], pa.int64())
        columns = [b.column(0).take(at), b.column(1).take(at), pa.array(places, pa.int64()), *(pa.array(c, pa.int32()) for c in (leaf, leaves, words)), both[: len(names)], both[len(names) :]]
        return pa.RecordBatch.from_arrays(columns, names=[u.split()[0] for u in UNITS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, found = [], []
            for i, value in enumerate(b.column(2)):
                for unit in unit_digests(value.as_py(), separator, min_words, sentence_words):
                    rows.append(i)
                    found.append(unit)
                    if len(found) >= UNITS_HELD:
                        yield part(b, rows, found)
                        rows, found = [], []
            yield part(b, rows, found)

    return settle(own_rows(docs, text).mapInArrow(run, UNITS), "units")


def outermost(found: list[dict]) -> list[dict]:
    """Units without the sentences of lines that are among them."""
    lines = {u["place"] >> SENTENCE_BITS for u in found if not u["place"] & ((1 << SENTENCE_BITS) - 1)}
    return [u for u in found if not u["place"] & ((1 << SENTENCE_BITS) - 1) or u["place"] >> SENTENCE_BITS not in lines]


def run_words(units: list[dict]) -> list[int]:
    """Words of each run of units (none within another) that follow on each other."""
    out, end = [], None
    for u in sorted(units, key=lambda u: u["leaf"]):
        if u["leaf"] == end:
            out[-1] += u["words"]
        else:
            out.append(u["words"])
        end = u["leaf"] + u["leaves"]
    return out


def counts_of(found: list[dict]) -> tuple[int, int, int, int]:
    """COUNTS of a document's repeated units."""
    seen = outermost(found)
    long = [n for n in run_words(seen) if n >= PASSAGE_WORDS]
    return len(seen), sum(u["words"] for u in seen), len(long), sum(long)


def repeated_units(docs: DataFrame, separator: str = "\n", min_words: int = MIN_WORDS, sentence_words: int = SENTENCE_WORDS, text: str = "text") -> DataFrame:
    """doc_id, key, places (of the units that go) and COUNTS: of documents with repeated units. Written out."""
    units = name_units(docs, separator, min_words, sentence_words, text)
    first = units.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "key", "place")).alias("first")).filter("n > 1").drop("n")
    # a plain side of the join: AQE can split a line that a third of all documents hold
    met = units.join(settle(first, "units-first"), ["d1", "d2"])
    gone = ~F.struct("doc_id", "key", "place").eqNullSafe(F.col("first"))
    found = met.groupBy(*ROW).agg(F.collect_set(F.struct("place", "leaf", "leaves", "words", gone.alias("gone"))).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places, counts = [], []
            for value in b.column(2):  # a document at a time, as units take much more room as objects
                own = value.as_py()
                places.append(pa.scalar(sorted(u["place"] for u in outermost([u for u in own if u["gone"]])), pa.list_(pa.int64())))
                counts.append(counts_of(own))
            columns = zip(*counts, strict=True) if counts else ((),) * len(COUNTS)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(places, pa.list_(pa.int64())), *(pa.array(c, pa.int64()) for c in columns)], names=[*ROW, "places", *COUNTS])

    return settle(found.mapInArrow(run, f"doc_id long, key long, places array<long>, {', '.join(f'{c} long' for c in COUNTS)}"), "units-repeated")


def cut_units(text: str, places: set[int], separator: str) -> tuple[str, list[tuple[int, int]]]:
    """The text without the units at places, and their spans in it. Lines are put together by the separator again."""
    kept, spans, at = [], [], 0
    cut_lines = {p >> SENTENCE_BITS for p in places}
    for i, line in enumerate(text.split(separator)):
        if i << SENTENCE_BITS in places:
            spans.append((at, at + len(line)))
        elif i not in cut_lines:
            kept.append(line)
        else:
            rest, pos = [], at
            for j, part in enumerate(sentences(line), 1):
                if i << SENTENCE_BITS | j in places:
                    spans.append((pos, pos + len(part)))
                else:
                    rest.append(part)
                pos += len(part)
            kept.append("".join(rest))
        at += len(line) + len(separator)
    return separator.join(kept), spans


def dedup_units(docs: DataFrame, separator: str = "\n", min_words: int = MIN_WORDS, sentence_words: int = SENTENCE_WORDS, text: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_removed, spans (start:end, joined by commas), COUNTS and kept (the text that stays) of every document; digests:
    kept_chars and kept_sha256 in place of kept, so that whole texts aren't shuffled."""
    found = repeated_units(docs, separator, min_words, sentence_words, text)
    held = found.select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"), "places", *COUNTS)
    gone = held.filter(F.size("places") > 0)
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("key") == F.col("__key"))
    out = {"kept_chars": pa.int64(), "kept_sha256": pa.string()} if digests else {"kept": pa.string()}
    finish = (lambda kept: (len(kept), hashlib.sha256(kept.encode("utf-8", "replace")).hexdigest())) if digests else (lambda kept: (kept,))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc_id, value, places, *counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                kept, spans = cut_units(value, set(places), separator)
                rows.append((doc_id, len(spans), ",".join(f"{s}:{e}" for s, e in spans), *counts, *finish(kept)))
            kinds = (pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * len(COUNTS), *out.values())
            cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "n_removed", "spans", *COUNTS, *out])

    touched = matching_rows(docs, gone.select(F.col("__key").alias("key")), text).join(gone, same)
    kinds = ", ".join(f"{c} {'long' if t == pa.int64() else 'string'}" for c, t in ({c: pa.int64() for c in COUNTS} | out).items())
    changed = touched.select("doc_id", "text", "places", *COUNTS).mapInArrow(run, f"doc_id long, n_removed long, spans string, {kinds}")
    whole = [F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256")] if digests else [F.col("text").alias("kept")]
    own = own_rows(docs, text).select("doc_id", "key", *whole).join(held, same, "left").filter(F.coalesce(F.size("places"), F.lit(0)) <= 0)
    zero = F.lit(0).cast("long")
    light = own.select("doc_id", zero.alias("n_removed"), F.lit("").alias("spans"), *[F.coalesce(c, zero).alias(c) for c in COUNTS], *out)
    return light.unionByName(changed)

"""Sanitising personal data: patterns find protected entities, corpus co-occurrence finds terms that reveal them.

base_spans() finds e-mail addresses, IP addresses, card and phone numbers. Each distinct value is an entity. For a term t seen
near an entity e (CONTEXT characters to either side) in n_te documents, of n_t with the term, n_e with the entity and N in
all, the disclosure is PMI(t, e) / IC(e) = ln(N n_te / (n_t n_e)) / ln(N / n_e): the share of the entity's information
that the term gives away. From SUPPORT documents on, a disclosure of GENERALISE or more puts a category in the term's place,
wherever it stands in the corpus, and one of REMOVE or more removes it. Base spans always stay.

Texts are scanned twice and never shuffled for detection. Between the scans a bit table of fixed size (512 KB) tells which
words may be candidate terms; exact counts and joins by term follow for those that pass it. Entities are held as 64-bit
hashes.

A null text is empty; rows equal in doc_id and text share their spans, and each counts as a document; an empty table gives
an empty result; extra columns pass through sanitise() untouched.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velograph.llm.shared import bit_table, free_name, settle, whole_text

KINDS = ("email", "ip", "card", "phone", "term")
CONTEXT, SUPPORT, GENERALISE, REMOVE = 60, 3, 0.8, 0.95
#: One in so many texts is searched first, for a lower bound of each term's documents; it changes no result.
BOUND_PART = 16
#: Bits of the candidate table, as a power of two.
TABLE_BITS = 22

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits is tried from its start only: a later start meets what the first one met.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")
NOT_DIGIT = re.compile(r"[^0-9]")

SCANNED = "doc_id long, key long, n_email long, n_ip long, n_card long, n_phone long, base string, mentions array<struct<entity:long,term:string>>"
MENTIONS = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.string())]))


def email_spans(text: str) -> list[tuple[int, int]]:
    """Of each @, the longest run of local characters to its left that no earlier match holds, and a domain to its right."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
        end = max(end, 0)
    return found


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of e-mail, ip, card and phone, in code points, ends exclusive; matches that fail their check are dropped."""
    out = [email_spans(text)]
    out.append([m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))])
    cards = ((m.span(), NOT_DIGIT.sub("", m[0])) for m in CARD.finditer(text) if m.end() - m.start() >= 13)
    out.append([span for span, digits in cards if 13 <= len(digits) <= 19 and luhn(digits)])
    out.append([m.span() for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15] if "+" in text else [])
    return out


def spell(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join([f"{kind}:{s}:{e}" for kind, found in zip(KINDS, spans) for s, e in sorted(found)])


def entity_hash(kind: int, value: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value.lower()}".encode(), digest_size=8).digest(), "big", signed=True)


def mentions(text: str, spans: list[list[tuple[int, int]]]) -> set[tuple[int, str]]:
    """Distinct (entity, term) of the contexts of the spans; words cut at the context's edge or within a span don't count."""
    flat = sorted((s, e, k) for k, found in enumerate(spans) for s, e in found)
    out = set()
    for i, (s, e, k) in enumerate(flat):
        entity = entity_hash(k, text[s:e])
        lo, hi = max(0, s - CONTEXT), min(len(text), e + CONTEXT)
        near = flat[max(0, i - 4) : i + 5]
        for m in TERM.finditer(text, lo, hi):
            a, b = m.span()
            cut = a == lo > 0 and text[a - 1].isalpha() or b == hi < len(text) and text[b].isalpha()
            if not cut and not any(x < b and a < y for x, y, _ in near):
                out.add((entity, m[0].lower()))
    return out


def text_key(text: str = "text") -> Column:
    return F.xxhash64(whole_text(text))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Base findings of each document, and the terms near them (see SCANNED); written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(2):
                value = value.as_py()
                spans = base_spans(value)
                rows.append((*map(len, spans), spell(spans), [{"entity": e, "term": t} for e, t in sorted(mentions(value, spans))] if any(spans) else []))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), MENTIONS]
            names = ["doc_id", "key", "n_email", "n_ip", "n_card", "n_phone", "base", "mentions"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], names=names)

    own = docs.select(F.col("doc_id").cast("long"), text_key(text).alias("key"), whole_text(text).alias("text"))
    return settle(own.mapInArrow(run, SCANNED), "pii-scan")


def word_bit(word: str) -> int:
    return zlib.crc32(word.encode("utf-8")) & ((1 << TABLE_BITS) - 1)


def occurrences(docs: DataFrame, table: bytes, text: str = "text") -> DataFrame:
    """(doc_id, key, term, spots): where words that the table lets through stand."""
    bits = docs.sparkSession.sparkContext.broadcast(np.unpackbits(np.frombuffer(table, np.uint8), bitorder="little").tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes: dict[str, int] = {}
        table = bits.value
        for batch in batches:
            out: list[tuple] = []
            for doc_id, key, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lower = value.lower()
                spots: dict[str, list[tuple[int, int]]] = {}
                for w in set(TERM.findall(lower)):
                    hit = passes.get(w)
                    if hit is None:
                        if len(passes) > 300_000:
                            passes.clear()
                        hit = passes[w] = table[word_bit(w)]
                    if hit:
                        spots[w] = []
                if spots:
                    # offsets are the text's own: a letter may change length in lower case
                    for m in TERM.finditer(value):
                        if (at := spots.get(m[0].lower())) is not None:
                            at.append(m.span())
                    out += [(doc_id, key, w, [a for a, _ in at], [b for _, b in at]) for w, at in spots.items() if at]
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "key", "term", "starts", "ends"])

    own = docs.select(F.col("doc_id").cast("long"), text_key(text).alias("key"), whole_text(text).alias("text"))
    return own.mapInArrow(run, "doc_id long, key long, term string, starts array<int>, ends array<int>")


def disclosures(scanned: DataFrame, docs: DataFrame, text: str = "text", support: int = SUPPORT, generalise: float = GENERALISE) -> tuple[DataFrame, DataFrame] | None:
    """(term, disclosure) of the terms over the threshold, and where candidate terms stand; None without candidates."""
    seen = scanned.filter(F.size("mentions") > 0)
    n = scanned.count()
    tally = lambda rows, name, *keys: rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    share = lambda n_t: F.log(F.lit(float(n)) * F.col("n_te") / (F.col(n_t) * F.col("n_e"))) / F.log(F.lit(float(n)) / F.col("n_e"))
    entities = tally(seen.select(F.explode(F.array_distinct("mentions.entity")).alias("entity")), "n_e", "entity")
    # a term is in all the documents where it stands near any entity, so this count bounds its disclosure from above
    near = tally(seen.select(F.explode(F.array_distinct("mentions.term")).alias("term")), "n_near", "term")
    pairs = tally(seen.select(F.explode("mentions").alias("m")), "n_te", "m.entity", "m.term").filter(F.col("n_te") >= support)
    pairs = pairs.join(entities, "entity").filter(F.col("n_e") < n).join(near, "term").filter(share("n_near") >= generalise)
    pairs = settle(pairs.select("entity", "term", "n_te", "n_e"), "pii-pairs")
    if pairs.isEmpty():
        return None
    # what a part of the texts shows is a bound as well: it takes common words out before all texts are searched for them
    part = docs.filter(F.pmod(text_key(text), F.lit(BOUND_PART)) == 0)
    seen = tally(occurrences(part, bit_table(pairs, F.crc32(F.encode("term", "UTF-8")), TABLE_BITS), text), "n_part", "term")
    bounded = pairs.join(seen, "term", "left").withColumn("n_part", F.coalesce("n_part", F.lit(1)))
    pairs = settle(bounded.filter(share("n_part") >= generalise).drop("n_part"), "pii-pairs")
    if pairs.isEmpty():
        return None
    spots = settle(occurrences(docs, bit_table(pairs, F.crc32(F.encode("term", "UTF-8")), TABLE_BITS), text), "pii-spots")
    found = pairs.join(tally(spots, "n_t", "term"), "term").withColumn("disclosure", share("n_t"))
    found = found.filter(F.col("disclosure") >= generalise).groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    return settle(found, "pii-terms"), spots


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """scan()'s columns without mentions, and terms: array of (start, end, disclosure) in order of place."""
    scanned = scan(docs, text)
    base = scanned.drop("mentions")
    got = disclosures(scanned, docs, text)
    if got is None:
        return base.withColumn("terms", F.expr("cast(array() as array<struct<start:int,end:int,disclosure:double>>)"))
    terms, spots = got
    each = spots.join(terms, "term").select("doc_id", "key", "disclosure", F.explode(F.arrays_zip("starts", "ends")).alias("x"))
    each = each.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set(F.struct(F.col("x.starts").alias("start"), F.col("x.ends").alias("end"), "disclosure"))).alias("terms"))
    each = each.select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"), "terms")
    joined = base.join(each, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("key") == F.col("__key")), "left").drop("__doc", "__key")
    return joined.withColumn("terms", F.coalesce("terms", F.expr("cast(array() as array<struct<start:int,end:int,disclosure:double>>)")))


def redact(text: str, base: str, terms: list[dict], remove: float = REMOVE) -> str:
    """The text with each base span as its kind in brackets, terms generalised or removed; overlapping spans become one."""
    spans = [(int(s), int(e), f"[{k.upper()}]") for k, s, e in (x.split(":") for x in base.split(",") if x)]
    spans += [(t["start"], t["end"], "" if t["disclosure"] >= remove else "[TERM]") for t in terms]
    out, at = [], 0
    for s, e, put in sorted(spans):
        if s >= at:
            out += [text[at:s], put]
        at = max(at, e)
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the text sanitised, all other columns as they were; texts with nothing to change keep their null."""
    found = find(docs, text).filter("base <> '' OR size(terms) > 0")
    hits = settle(found.dropDuplicates(["doc_id", "key"]).select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"), "base", "terms"), "pii-found")
    # the row travels as one column, so that no other name can clash with what joins it
    keyed = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").cast("long").alias("__id"), text_key(text).alias("__k"))
    same = F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__k") == F.col("__key"))
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fresh = [redact(value, base, terms or []) if value is not None and base is not None else value for value, base, terms in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True)]
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(fresh, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = keyed.join(hits, same, "left").select("__row.*", F.col("base").alias(free_name("base", names)), F.col("terms").alias(free_name("terms", names)))
    return joined.mapInArrow(run, docs.schema)

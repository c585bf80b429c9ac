"""Byte-pair encoding and decoding with a contiguous rank array.

Semantics are those of a BPE vocabulary file with an end-of-word suffix (lower-casing normaliser, byte-level
alphabet). Each pre-token keeps two parallel arrays, the part ids and the rank of the merge of each part with its right
neighbour. The smallest rank is found by a scan, its boundary is deleted, and only the two neighbouring ranks are
refreshed. The scan is quadratic, so it serves short words; longer ones use the same merges over a heap, with
equal results. Results are kept per distinct word in a bounded cache, so a task's memory doesn't follow its input.

Nulls are encoded as the empty text (no tokens, empty decoded text); rows are independent, so repeated
rows, ties and extra columns need no rule, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NONE = 1 << 60
#: Words with more bytes than this take the heap.
SHORT_WORD = 96
#: Distinct words that a worker keeps.
CACHE_WORDS = 200_000

KINDS = {
    "n_tokens": (T.LongType(), pa.int64()),
    "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "decoded": (T.StringType(), pa.string()),
    "ids_sha256": (T.StringType(), pa.string()),
    "decoded_sha256": (T.StringType(), pa.string()),
}


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else the next free code point from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in printable else chr(spare))
        spare += b not in printable
    return out


class RankArrayBpe:
    """A vocabulary, its merge ranks, and the bounded per-word cache."""

    def __init__(self, spec: str, cache_words: int = CACHE_WORDS):
        data = json.loads(spec)
        model = data["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
        self.token_of = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.merge = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merge[vocab[left], vocab[right]] = (rank, vocab[left + right])
        letters = byte_alphabet()
        self.inner = [vocab.get(c) for c in letters]
        self.final = [vocab.get(c + self.suffix) for c in letters]
        self.words = regex.compile(data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache_words = cache_words
        self.cache: dict[str, tuple[str, str]] = {}

    def symbols(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        ids = [self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]]
        return [i for i in ids if i is not None]

    def encode_word(self, word: str) -> list[int]:
        parts = self.symbols(word)
        return self.merge_short(parts) if len(parts) <= SHORT_WORD else self.merge_long(parts)

    def merge_short(self, parts: list[int]) -> list[int]:
        merge = self.merge
        ranks = [merge.get(pair, (NONE,))[0] for pair in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NONE:
                break
            at = ranks.index(low)
            parts[at] = merge[parts[at], parts[at + 1]][1]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = merge.get((parts[at], parts[at + 1]), (NONE,))[0]
            if at:
                ranks[at - 1] = merge.get((parts[at - 1], parts[at]), (NONE,))[0]
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same merges in the same order; a heap of (rank, place) over linked boundaries."""
        merge, n = self.merge, len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(hit[0], i, parts[i], parts[i + 1]) for i in range(n - 1) if (hit := merge.get((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue
            parts[i], parts[j] = merge[left, right][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (hit := merge.get((parts[a], parts[b]))):
                    heapq.heappush(heap, (hit[0], a, parts[a], parts[b]))
        return [p for p in parts if p >= 0]

    def normalise(self, text: str) -> str:
        """NFC and lower case letter by letter (so no word-final sigma); spaces never reach a word."""
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def pieces(self, text: str) -> Iterator[str]:
        """Pre-tokens and special tokens, in order."""
        if self.split_special is None or not any(s in text for s in self.special):
            yield from self.words.findall(self.normalise(text))
            return
        for part in self.split_special.split(text):
            if part in self.special:
                yield part
            elif part:
                yield from self.words.findall(self.normalise(part))

    def entry(self, word: str) -> tuple[str, str]:
        ids = [self.special[word]] if word in self.special else self.encode_word(word)
        return " ".join(map(str, ids)), self.decode(ids)

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, as a file without a decoder gives."""
        return " ".join(self.token_of[i] for i in ids if i in self.token_of)

    def encode_text(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by a space, and the decoded text."""
        cache = self.cache
        words = self.words.findall(self.normalise(text)) if not any(s in text for s in self.special) else list(self.pieces(text))
        try:
            found = [cache[w] for w in words]
        except KeyError:
            if len(cache) > self.cache_words:
                cache.clear()
            found = []
            for w in words:
                hit = cache.get(w)
                if hit is None:
                    hit = self.entry(w)
                    if len(w) <= 64:
                        cache[w] = hit
                found.append(hit)
        found = [f for f in found if f[0]]
        return " ".join([f[0] for f in found]), " ".join([f[1] for f in found])


def tokenize(df: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), emit: tuple[str, ...] = ("n_tokens", "ids", "decoded")) -> DataFrame:
    """The columns keep, and of each text what emit names (see KINDS). vocabulary: the file's path on the driver.

    A keep column whose name emit also uses is refused. The file's content (1.7 MB here) goes out once as a broadcast.
    """
    if clash := set(keep) & set(emit):
        raise ValueError(f"columns named twice: {sorted(clash)}")
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(e, KINDS[e][0]) for e in emit])
    held: dict[str, RankArrayBpe] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held.setdefault("bpe", RankArrayBpe(spec.value)) if "bpe" not in held else held["bpe"]
        for batch in batches:
            out = {e: [] for e in emit}
            for value in batch.column(len(keep)):
                ids, decoded = bpe.encode_text(value.as_py() or "")
                for e, col in out.items():
                    if e == "n_tokens":
                        col.append(ids.count(" ") + 1 if ids else 0)
                    elif e == "ids":
                        col.append([int(i) for i in ids.split(" ")] if ids else [])
                    elif e == "decoded":
                        col.append(decoded)
                    elif e == "ids_sha256":
                        col.append(hashlib.sha256(ids.encode()).hexdigest())
                    else:
                        col.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *(pa.array(out[e], KINDS[e][1]) for e in emit)], names=[*keep, *emit])

    return df.select(*keep, df[text].cast("string").alias("__text")).mapInArrow(run, schema)


def detokenize(df: DataFrame, vocabulary: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep and decoded, the text of an array of ids; null ids give the empty text, unknown ids are skipped."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("decoded", T.StringType())])

    def run(batches):
        bpe = RankArrayBpe(spec.value)
        for batch in batches:
            texts = [bpe.decode([i for i in row or [] if i is not None]) for row in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return df.select(*keep, df[ids].alias("__ids")).mapInArrow(run, schema)

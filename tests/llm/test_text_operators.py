"""BPE, quality, personal data, toxicity: against the library, SQL, plain patterns, planted cases."""

import hashlib
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from velograph.llm import pii, quality, toxicity
from velograph.llm.bpe import RankArrayBpe, detokenize, tokenize

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

ODD = ["", None, " \t\n", "a" * 700 + " " + "ab" * 400, "!" * 300, "ΑΣ İstanbul ẞ ½ 12३ it's 'S DON'T", "x<|endoftext|>y <|startoftext|>", "<|END<|endoftext|>OFTEXT|>", "日本 😀😀 é", "\x00\x1c\u0085​"]


def docs(spark, texts, **extra):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], SCHEMA)


def test_bpe_equals_the_library(spark):
    lib = tokenizers.Tokenizer.from_file(PATH)
    r = random.Random(2)
    texts = ODD + ["".join(r.choice(string.printable + "éßñ") for _ in range(200)) for _ in range(60)]
    rows = tokenize(docs(spark, texts), PATH).collect()
    for row in rows:
        ids = lib.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["n_tokens"] == len(ids) and row["decoded"] == lib.decode(ids, skip_special_tokens=False)
    again = detokenize(tokenize(docs(spark, texts), PATH, emit=("ids",)), PATH).collect()
    assert {r["doc_id"]: r["decoded"] for r in again} == {r["doc_id"]: r["decoded"] for r in rows}


def test_bpe_digests_empty_table_and_clashes(spark):
    row = tokenize(docs(spark, ["Hello there"]), PATH, emit=("n_tokens", "ids_sha256")).first()
    assert row["n_tokens"] == 2 and len(row["ids_sha256"]) == 64
    assert tokenize(docs(spark, []), PATH).count() == 0
    with pytest.raises(ValueError):
        tokenize(docs(spark, []).withColumn("ids", F.lit(1)), PATH, keep=("doc_id", "ids"))


def test_bpe_heap_equals_scan():
    with open(PATH, encoding="utf-8") as f:
        bpe = RankArrayBpe(f.read())
    r = random.Random(4)
    for _ in range(300):
        parts = bpe.symbols("".join(r.choice("abetion") for _ in range(r.randint(1, 60))))
        assert bpe.merge_short(list(parts)) == bpe.merge_long(list(parts))


def brute_repeats(words):
    seen, hit = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            hit.update(p for i in at for p in range(i, i + 8))
    return len(hit)


def test_quality_figures_and_verdict(spark):
    r = random.Random(1)
    texts = ["", None, " ", "w\n" * 50, "a b c d e f g h i\n\na b c d e f g h i", "# $ % word", "é" * 9000, " ".join(r.choice("ab") for _ in range(400)), " ".join("clean words of prose number".split() * 2 + [f"n{i}" for i in range(60)])]
    measured = quality.measure(docs(spark, texts))
    order = quality.plan_cascade(docs(spark, texts))
    rows = {x["doc_id"]: x for x in quality.cascade(measured, order).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        x = rows[i]
        assert (x["n_words"], x["word_chars"], x["n_dup_lines"], x["n_repeat_words"]) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)), brute_repeats(words))
        assert x["n_symbols"] == sum(c in "#*$%&|<>" for c in t or "") and x["base_failed"] == (len(words) < 20 or 100 * x["n_repeat_words"] > 30 * len(words))
    assert rows[8]["kept"] and rows[0]["rejected_by"] == "base" and {o["rule"].name for o in order} == {x.name for x in quality.RULES}


def test_a_rule_runs_only_where_none_before_it_has_rejected(spark):
    """A rule that fails wherever it is evaluated, behind one that rejects all, and behind the base test."""
    never = quality.Rule("never", "raise_error('evaluated') IS NULL")
    measured = quality.measure(docs(spark, ["a b c d e f g h i j k l m n o p q r s t u v w x"] * 3))
    first = quality.Rule("first", "length({text}) > 0")
    order = [{"rule": x, "cost": 1.0, "rejection": 0.0} for x in (first, never)]
    assert {x["rejected_by"] for x in quality.cascade(measured, order).collect()} == {"first"}
    short = quality.measure(docs(spark, ["too short", None]))
    assert {x["rejected_by"] for x in quality.cascade(short, order[::-1]).collect()} == {"base"}
    with pytest.raises(Exception, match="evaluated"):
        quality.cascade(measured, order[::-1]).collect()


def test_costly_rules_that_reject_nothing_come_last(spark):
    r = random.Random(6)
    texts = [" ".join(r.choice(["alpha", "beta", "gamma"]) + str(r.randrange(999)) for _ in range(400)) for _ in range(40)]
    costly = quality.Rule("costly", "length(regexp_replace(lower({text}), '([a-z])([a-z]*)([0-9]+)', '$3$2$1')) < 0")
    cheap = quality.Rule("cheap", "n_words > 100")
    plan = quality.plan_cascade(docs(spark, texts), (costly, cheap))
    by = {x["rule"].name: x for x in plan}
    assert [x["rule"].name for x in plan] == ["cheap", "costly"] and by["costly"]["cost"] > by["cheap"]["cost"] and by["cheap"]["rejection"] == 1.0


def test_quality_order_never_changes_the_verdict(spark):
    measured = quality.measure(docs(spark, ["x | y | z | q " * 9 + "u v w k l m n o p", "one two three " * 3 + " ".join(map(str, range(40)))]))
    plans = [[{"rule": r, "cost": 1.0, "rejection": 0.0} for r in rules] for rules in (quality.RULES, quality.RULES[::-1])]
    a, b = ({r["doc_id"]: r["kept"] for r in quality.cascade(measured, p).collect()} for p in plans)
    assert a == b
    assert quality.cascade(quality.measure(docs(spark, [])), quality.plan_cascade(docs(spark, []))).count() == 0
    with pytest.raises(ValueError):
        quality.measure(docs(spark, []).withColumn("n_words", F.lit(1)))


PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    ok = (lambda m: True, lambda m: all(int(p) <= 255 for p in m[0].split(".")), lambda m: 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m)), lambda m: 9 <= len(digits(m)) <= 15)
    return [[m.span() for m in re.finditer(p, t) if good(m)] for p, good in zip(PATTERNS, ok, strict=True)]


def test_base_spans_equal_the_patterns():
    r = random.Random(9)
    texts = ["4111 1111-1111 1111 and 1.2.3.4.5.6.7.8, a@b@c.d.e@f.g, +48 (12) 345-67-89", "é@x.pl 001.02.3.4 256.1.1.1", "9" * 5000, "a" * 5000 + "@"]
    for t in texts + ["".join(r.choice("a1.@-+ 2b()0é") for _ in range(50)) for _ in range(4000)]:
        assert pii.base_spans(t) == plain_spans(t)


def test_disclosing_terms_are_found_and_replaced(spark):
    secret = [f"contact zorblat ann{chr(97 + i)} at boss@corp.example today" for i in range(6)]
    noise = [f"contact the desk today {w}" for w in ("alpha", "beta", "gamma", "delta")] * 60
    texts = [*secret, "zorblat stands alone", None, "", *noise]
    found = {r["doc_id"]: r for r in pii.find(docs(spark, texts)).collect()}
    assert [(t["start"], t["end"]) for t in found[0]["terms"]] == [(8, 15)] and len(found[6]["terms"]) == 1 and not found[20]["terms"]
    assert found[0]["n_email"] == 1 and found[7]["base"] == ""
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs(spark, texts)).collect()}
    assert clean[0] == "contact [TERM] anna at [EMAIL] today" or clean[0] == "contact  anna at [EMAIL] today"
    assert clean[7] is None and clean[8] == "" and clean[20] == noise[11] and len(clean) == len(texts)
    assert pii.sanitise(docs(spark, [])).count() == 0 and pii.find(docs(spark, ["nothing here"])).first()["terms"] == []


def test_disclosure_equals_brute_force(spark):
    """PMI over information content of every term near every entity, by plain counts."""
    import math

    r = random.Random(13)
    names, mails = [f"name{chr(97 + i)}" for i in range(8)], [f"u{i}@corp.example" for i in range(5)]
    texts = []
    for _ in range(160):
        i = r.randrange(5)
        words = ["we", "wrote", r.choice(["report", "letter"]), names[i] if r.random() < 0.9 else r.choice(names)]
        texts.append(f"{' '.join(words)} {mails[i] if r.random() < 0.8 else ''} {' '.join(r.choice(names[4:] + ['meadow', 'river']) for _ in range(2))}")
    near, has, entity, n = {}, {}, {}, len(texts)
    for t in texts:
        terms = set(pii.TERM.findall(re.sub(PATTERNS[0], " ", t).lower()))
        # a mention's own letters stand in the text, too
        for w in set(x.lower() for x in pii.TERM.findall(t)):
            has[w] = has.get(w, 0) + 1
        for m in {m[0] for m in re.finditer(PATTERNS[0], t)}:
            entity[m] = entity.get(m, 0) + 1
            for w in terms:
                near[m, w] = near.get((m, w), 0) + 1
    want = {}
    for (m, w), c in near.items():
        share = math.log(n * c / (has[w] * entity[m])) / math.log(n / entity[m])
        if c >= pii.SUPPORT and share >= pii.GENERALISE:
            want[w] = max(want.get(w, 0.0), share)
    df = docs(spark, texts)
    got = pii.disclosures(pii.scan(df), df)
    assert got is not None and want
    assert {x["term"]: pytest.approx(x["disclosure"]) for x in got[0].collect()} == want
    for x in pii.find(df).collect():
        assert [(y["start"], y["end"]) for y in x["terms"]] == [m.span() for m in pii.TERM.finditer(texts[x["doc_id"]]) if m[0].lower() in want]


def test_overlapping_spans_become_one():
    t = "call +48 123 456 789 now"
    assert pii.redact(t, "card:6:20,phone:5:20", []) == "call [PHONE] now"


def toxic_corpus(spark):
    r = random.Random(3)
    words = ["house", "river", "table", "green", "walk", "paper", "north", "stone", "cloud", "field"]
    rows, labels = [], []
    for i in range(900):
        bad = i % 6 == 0
        body = [r.choice(words) for _ in range(30)]
        if bad:
            body.insert(r.randrange(30), r.choice(["blockhead", "nitwit"]))
        rows.append((i, " ".join(body)))
        labels.append((i, 1, int(bad)))
    rows += [(2000, "green bl0ckhe4d river"), (2001, "house n i t w i t table walk"), (2002, "paper nitwiiiit stone"), (2003, "green river table"), (2004, None), (2005, ""), (2003, "green river table")]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_disguised_words_score_as_themselves(spark):
    rows, labels = toxic_corpus(spark)
    model = toxicity.fit(rows, labels)
    scored = [(r["doc_id"], r["score"]) for r in toxicity.score(rows, model).collect()]
    by = dict(scored)
    assert all(by[i] >= 0.5 for i in (2000, 2001, 2002)) and all(by[i] < 0.5 for i in (2003, 2004, 2005)) and len(scored) == rows.count()
    held = {r["doc_id"] for r in rows.filter(toxicity.is_held_out()).collect()}
    assert all((by[i] >= 0.5) == (i % 6 == 0) for i in held if i < 900)
    kept = toxicity.reject(rows, labels)
    assert kept.columns == rows.columns and kept.filter("doc_id = 2000").isEmpty() and kept.filter("doc_id = 2003").count() == 2


def test_every_disguise_of_the_channel_reaches_the_decoder(spark):
    r = random.Random(6)
    words = ["house", "river", "table", "green", "walk", "paper", "north", "cloud"]
    rows, labels = [], []
    for i in range(900):
        body = [r.choice(words) for _ in range(20)]
        if i % 6 == 0:
            body.insert(r.randrange(20), r.choice(["idiot", "bass"]))
        rows.append((i, " ".join(body)))
        labels.append((i, 1, int(i % 6 == 0)))
    forms = ["1d107", "1d!0+", "id!0t", "!diot", "ba$$", "ba$$!", "iiddiioott", "bbaassss", "i d i o t", "i  d  i  o  t", "i - d - i - o - t", "i\td\ti\to\tt", "i_d_.i..o...t", "ii dd ii oo tt", "1 d 1 0 7"]
    plain = ["green 2024 river", "green! river!!", "5 8 4 1 7", "house (1,234.56) table $100"]
    rows += [(2000 + i, f"green {w} river") for i, w in enumerate(forms)] + [(3000 + i, w) for i, w in enumerate(plain)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    by = {x["doc_id"]: x["score"] for x in toxicity.score(df, model).collect()}
    assert [w for i, w in enumerate(forms) if by[2000 + i] < 0.5] == []
    assert "8455" in toxicity.marked("green 8455 river")  # no plain letter; the language model decides what it is
    assert [w for i, w in enumerate(plain) if by[3000 + i] >= 0.5] == []


def test_without_labels_nothing_is_toxic(spark):
    rows, labels = toxic_corpus(spark)
    model = toxicity.fit(rows, labels.filter("false"))
    assert toxicity.score(rows, model).agg(F.max("score")).first()[0] == 0.0
    assert toxicity.score(rows.filter("false"), model).count() == 0


def test_long_words_are_decoded_in_bounded_time():
    decoder = toxicity.Decoder(toxicity.np.ones(toxicity.SIDE**3))
    assert len(decoder.restore("a1" * 3000)) > 1000
    assert hashlib.sha256(b"").hexdigest()[:6] == "e3b0c4"

"""Toxicity, sanitisation, language identification: held-out results, brute force, cases."""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from iterweave.llm import op05_toxicity, op08_sanitise, op10_ppm_language
from tests.llm.helpers import docs, words

SF = "/root/testdata/sf0.01"

# --- toxicity ----------------------------------------------------------------

LABELS = "doc_id long, quality int, toxic int, _extra string"


def _labelled(n, seed):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        toxic, poor = rng.random() < 0.3, rng.random() < 0.3
        text = words(40, seed * 10**5 + i, 300) + ["zqvile"] * toxic + ["xxjunk"] * poor
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        labels.append((i, int(not poor), int(toxic), "x"))
    return rows, labels


def test_held_out_texts_are_classified(spark, ws):
    rows, labels = _labelled(400, 1)
    known = spark.createDataFrame(labels[:300], LABELS)
    chain = op05_toxicity.train(docs(spark, rows), known, op05_toxicity.categories_of(), ws)
    got = {r.doc_id: r for r in op05_toxicity.score(docs(spark, rows), chain).collect()}
    wrong = sum(got[i].toxic != bool(t) for i, _, t, _ in labels[300:])
    assert wrong <= 2
    assert sum((got[i].p_low_quality > 0.5) != (not q) for i, q, _, _ in labels[300:]) <= 2
    assert all(0 <= r.p_toxic <= 1 for r in got.values())


def test_held_out_accuracy_on_the_tables(spark, ws):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) == 0
    chain = op05_toxicity.train(table, labels.filter(~held), op05_toxicity.categories_of(), ws)
    pairs = op05_toxicity.score(table, chain).join(
        labels.filter(held).select("doc_id", F.col("toxic").alias("truth")), "doc_id"
    )
    right = pairs.filter(F.col("toxic") == (F.col("truth") == 1)).count()
    assert right / pairs.count() > 0.9


def test_later_links_use_earlier_categories(spark, ws):
    # The second category is the first one's opposite, and labels say nothing else.
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(300):
        first = rng.random() < 0.5
        rows.append((i, " ".join([f"alpha{rng.randrange(3)}" if first else f"omega{rng.randrange(3)}", "x"])))
        labels.append((i, int(first), int(first), "x"))
    known = spark.createDataFrame(labels, LABELS)
    chain = op05_toxicity.train(docs(spark, rows), known, op05_toxicity.categories_of(), ws)
    assert [len(link.earlier) for link in chain.links] == [0, 1] and chain.links[1].earlier[0] < 0


def test_toxicity_edge_cases(spark, ws):
    rows, labels = _labelled(60, 2)
    odd = [(1000, None), (1001, ""), (None, "zqvile zqvile"), (1, "twice"), (1, "twice")]
    more = [(None, 1, 1, ""), (7, None, 1, ""), (8, 1, None, ""), (5000, 1, 1, ""), (1, 0, 1, ""), (1, 1, 0, "")]
    table = docs(spark, rows + odd).withColumn("toxic", F.lit("clash"))
    known = spark.createDataFrame(labels + more, LABELS)
    scored = op05_toxicity.score(table, op05_toxicity.train(table, known, op05_toxicity.categories_of(), ws))
    got = scored.collect()
    assert len(got) == len(rows) + len(odd)
    assert not any(r.toxic for r in got if r.doc_id in (1000, 1001))
    assert scored.columns == [*(c for c in table.columns if c != "toxic"), "p_low_quality", "p_toxic", "toxic"]
    for some in (known.limit(0), known.filter("toxic = 0"), known.filter("toxic = 1")):
        chain = op05_toxicity.train(table, some, op05_toxicity.categories_of(), ws)
        assert op05_toxicity.score(table, chain).count() == len(rows) + len(odd)
    nothing = op05_toxicity.train(table, known.limit(0), op05_toxicity.categories_of(), ws)
    assert op05_toxicity.score(table, nothing).filter("toxic").count() == 0
    assert op05_toxicity.score(table.limit(0), nothing).count() == 0


# --- personal data -----------------------------------------------------------

# As stated, without the operator's look-behinds and loops.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    out = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                luhn = sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
                if not 14 <= len(digits) <= 19 or luhn % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), no, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def test_base_spans_match_the_patterns():
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@+-( )9_%2 4é") for _ in range(rng.randrange(50)))
        assert op08_sanitise.base_spans(text) == _plain_spans(text), text
    assert op08_sanitise.base_spans("4111 1111-1111 1111") == [("card", 0, 19)]
    assert op08_sanitise.base_spans("1.2.3.0004 x 1.2.3.256") == [("ip", 0, 10)]


def test_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "@" * 300_000, "+1(" * 100_000, "1." * 150_000, "a@" * 150_000):
        op08_sanitise.base_spans(text)


def _brute_revealing(rows, near=8):
    """Straight from the definition, by loops."""
    word = re.compile(r"[^\W\d_]{3,}")
    with_term, entity_docs, both, wordings = Counter(), Counter(), Counter(), {}
    for _, text in rows:
        text = text or ""
        with_term.update({w.lower() for w in word.findall(text)})
        base = _plain_spans(text)
        free = [m for m in word.finditer(text) if not any(s < m.end() and m.start() < e for _, s, e in base)]
        terms, windows = {}, {}
        for kind, start, end in base:
            e = op08_sanitise.entity_of(kind, text[start:end])
            before = [m[0].lower() for m in free if m.start() < start][-near:]
            after = [m[0].lower() for m in free if m.start() >= start][:near]
            terms.setdefault(e, set()).update(before + after)
            windows.setdefault(e, set()).add(" ".join(before + after))
        entity_docs.update(list(terms))
        for e, found in terms.items():
            for t in found:
                both[e, t] += 1
                wordings.setdefault((e, t), set()).add(frozenset(windows[e]))
    revealing = set()
    for (e, t), n in both.items():
        share = n / with_term[t]
        bits = math.log2(share * len(rows) / entity_docs[e])
        if len(wordings[e, t]) >= 3 and share >= 0.5 and bits >= 4:
            revealing.add(t)
    return revealing


def _private_rows():
    rng, rows = random.Random(6), []
    common = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa"]
    filler = lambda n: [rng.choice(common) for _ in range(n)]
    for i in range(40):  # the nickname gives the address away, also where it stands alone
        rows.append(" ".join([*filler(6), "Foxglove", *filler(2), "jo@x.org", *filler(9)]))
        rows.append(" ".join(filler(20)))
    rows = rows[:8] + rows[8:] * 3
    rows += [" ".join(filler(4) + ["foxglove"] + filler(3)) for _ in range(5)]
    rows += [" ".join(filler(30))] * 3000
    rows += ["copied uniquely jo2@x.org"] * 9 + ["", None, "1.2.3.4", "Foxglove@x.org foxglove"]
    return list(enumerate(rows))


def test_terms_that_reveal_match_brute_force(spark, ws):
    rows = _private_rows()
    table = docs(spark, rows)
    want = _brute_revealing(rows)
    assert "foxglove" in want and "uniquely" not in want
    found = op08_sanitise.found_entities(table)
    got = {r.term for r in op08_sanitise.revealing_terms(table, found, ws).collect()}
    assert got == want
    by_id = {r.doc_id: r for r in op08_sanitise.op8_sanitise(spark, table).collect()}
    assert len(by_id) == len(rows)
    for i, text in rows:
        text = text or ""
        base = _plain_spans(text)
        terms = [
            (op08_sanitise.TERM, *m.span())
            for m in re.finditer(r"[^\W\d_]{3,}", text)
            if m[0].lower() in want and not any(s < m.end() and m.start() < e for _, s, e in base)
        ]
        spell = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert by_id[i].base_sha256 == hashlib.sha256(spell(base).encode()).hexdigest()
        assert by_id[i].spans == spell(sorted(base + terms, key=lambda s: s[1]))
    clean = {r.doc_id: r.text for r in op08_sanitise.sanitise(table).collect()}
    assert clean[rows[-1][0]] == "<EMAIL> <TERM>" and clean[rows[-3][0]] is None
    assert not any("jo@" in (t or "") or "foxglove" in (t or "").lower() for t in clean.values())


def test_terms_of_rare_entities_are_judged(spark, ws):
    """Three wordings in one document count as three, two wordings are judged by smoothing."""
    rows = [
        " and ".join(f"mallow {w} ada@x.org {w}{w} calm dull even fair glad huge idle just" for w in ("one", "two", "six")),
        "here yarrow wrote bob@x.org again",
        "there yarrow sent bob@x.org today",
        *["only tansy met cy@x.org"] * 5,
        "once sorrel saw dee@x.org now",
        "then sorrel saw dee@x.org soon",
        *["sorrel grows"] * 3,
        *["filler text"] * 300,
    ]
    table = docs(spark, list(enumerate(rows)))
    [context] = op08_sanitise.contexts(rows[0], op08_sanitise.base_spans(rows[0]))
    assert len(context["windows"]) == 3
    found = op08_sanitise.found_entities(table)
    got = {r.term for r in op08_sanitise.revealing_terms(table, found, ws).collect()}
    assert {"mallow", "yarrow"} <= got
    assert not {"tansy", "sorrel", "filler"} & got  # copies of one wording; mostly elsewhere
    by_id = {r.doc_id: r for r in op08_sanitise.op8_sanitise(spark, table).collect()}
    assert by_id[1].spans == "term:5:11,email:18:27"


def test_sanitise_edge_cases(spark):
    rows = [(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c"), (1, "other"), (2, None)]
    got = op08_sanitise.sanitise(docs(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.text or "-") for r in got) == [
        ("1", "<EMAIL>"), ("1", "<EMAIL>"), ("1", "other"), ("2", "-"), ("None", "<EMAIL>")]
    assert op08_sanitise.op8_sanitise(spark, docs(spark, [])).count() == 0


# --- languages ---------------------------------------------------------------


def test_probabilities_sum_to_one_and_follow_the_counts():
    text = b"abracadabra abracadabra. \xc3\xa9t\xc3\xa9!"
    grams, n = np.unique(op10_ppm_language.grams(text), return_counts=True)
    model = op10_ppm_language.build([("x", int(g), int(k)) for g, k in zip(grams, n, strict=True)])
    p = np.exp2(-model.bits.astype(float)).reshape(-1, model.width)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4) and (p > 0).all()
    symbol = {c: model.symbols[ord(c)] for c in "abrcd"}
    row = model.rows[(symbol["a"] * model.width + symbol["b"]) * model.width + symbol["r"]]
    assert p[row, symbol["a"]] == pytest.approx(4 / 5, rel=1e-4)  # 4 times "a", one escape
    shorter = p[model.rows[(symbol["c"] * model.width + symbol["c"]) * model.width + symbol["r"]]]
    rest = 1 - shorter[symbol["a"]]  # "cr" is unseen: the statistics after "r"
    assert p[row, symbol["c"]] == pytest.approx(shorter[symbol["c"]] / rest / 5, rel=1e-3)


def test_code_lengths_are_sums_whatever_the_slices(monkeypatch):
    text = " ".join(words(400, 1)).encode()
    grams, n = np.unique(op10_ppm_language.grams(text[:800]), return_counts=True)
    model = op10_ppm_language.build([("x", int(g), int(k)) for g, k in zip(grams, n, strict=True)])
    whole = model.code_lengths(text)
    monkeypatch.setattr(op10_ppm_language, "SLICE", 7)
    assert model.code_lengths(text) == pytest.approx(whole)


def _counted(texts):
    rows = []
    for lang, held in texts.items():
        parts = [op10_ppm_language.grams(t) for t in held]
        found, n = np.unique(np.concatenate(parts), return_counts=True)
        rows += [(lang, int(g), int(k)) for g, k in zip(found, n, strict=True)]
    return rows


def _direct_ppm(texts, data, longest=3):
    """{language: code length} by dictionaries of contexts, one symbol at a time."""
    base = op10_ppm_language.BASE
    used = {0} | {int(base[b]) for held in texts.values() for t in held for b in t}
    width, found = len(used) + 1, {}
    spell = lambda t: [0] * 3 + [x if x in used else -1 for x in (int(base[b]) for b in t)]
    symbols = [*sorted(used), -1]
    for lang, held in texts.items():
        counts = {}
        for s in map(spell, held):
            for i in range(3, len(s)):
                for k in range(longest + 1):
                    tree = counts.setdefault(tuple(s[i - k : i]), {})
                    tree[s[i]] = tree.get(s[i], 0) + 1

        @functools.cache
        def chances(context, counts=counts, below=None):
            shorter = {x: 1 / width for x in symbols} if not context else chances(context[1:])
            seen = counts.get(context)
            if not seen:
                return shorter
            escapes = len(seen) if len(seen) < width else 0
            total = sum(seen.values()) + escapes
            left = sum(p for x, p in shorter.items() if x not in seen)
            return {x: seen[x] / total if x in seen else escapes / total * shorter[x] / left for x in symbols}

        s = spell(data)
        found[lang] = -sum(math.log2(chances(tuple(s[i - longest : i]))[s[i]]) for i in range(longest, len(s)))
    return found


def test_code_lengths_are_those_of_a_direct_ppm():
    rng = random.Random(3)
    texts = {
        "a": [" ".join(words(60, i, 40)).encode() for i in range(4)],
        "b": ["".join(rng.choice("abc é,") for _ in range(300)).encode(), b"", b"Zz"],
        "c": [b"one single line."],
    }
    model = op10_ppm_language.build(_counted(texts))
    for data in (b"", b"abc", "w12 w3 \xe9t\xe9 q\u20ac".encode(), texts["a"][0], b"zzz ~ 9"):
        want = _direct_ppm(texts, data)
        assert model.code_lengths(data) == pytest.approx([want[x] for x in model.languages], rel=1e-4, abs=1e-3)


def test_a_rare_language_keeps_its_own_contexts():
    much = [" ".join(words(3000, i)).encode() for i in range(3)]
    little = [b"der hund und die katze und der bund"]
    limit = 40  # far fewer than the large language has
    model = op10_ppm_language.build(_counted({"big": much, "small": little}), max_contexts=limit)
    alone = op10_ppm_language.build(_counted({"big": [b"x"], "small": little}), max_contexts=limit)
    kept = lambda m: (m.rows >= m.width).sum()
    assert kept(model) >= kept(alone)
    assert model.predict(b"und die katze")[0] == "small"
    wide = op10_ppm_language.build(_counted({"big": much, "small": little}))
    at = model.languages.index("small")
    assert model.code_lengths(little[0])[at] == pytest.approx(wide.code_lengths(little[0])[at], rel=1e-4)


def test_held_out_languages(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = op10_ppm_language.op10_language_id(spark, table).join(table.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out")
    assert held.count() > 100
    assert held.filter("lang = lang_pred").count() / held.count() > 0.98
    assert got.filter("score < 0 or score > 1").count() == 0


def test_language_edge_cases(spark):
    rows = [(i, "the cat and the dog", "en", None) for i in range(8)]
    rows += [(i, "der hund und die katze", "de", None) for i in range(8, 16)]
    rows += [(20, None, "en", None), (21, "", None, None), (22, "12 34 !", "en", None), (23, "é", None, None),
             (None, "und der hund", "xx", None), (24, "the dog", None, None), (24, "the dog", None, None)]
    got = [(r.doc_id, r.lang_pred) for r in op10_ppm_language.op10_language_id(spark, docs(spark, rows)).collect()]
    by_id = dict(got)
    assert by_id[20] == by_id[21] == by_id[22] == "und" and by_id[23] in ("de", "en")
    assert by_id[None] == "de" and by_id[24] == "en" and len(got) == len(rows)
    unlabelled = op10_ppm_language.op10_language_id(spark, docs(spark, [(1, "abc", None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]
    assert op10_ppm_language.op10_language_id(spark, docs(spark, [])).count() == 0

"""WARC derivatives, line dedup, mixing, chat formatting: edge cases and round trips.
Whole tables are compared with SQL in test_queries.py."""

from __future__ import annotations

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from iterweave.llm import op01_warc, op02_line_dedup, op03_mixing, op04_chat_trees
from iterweave.workspace import Workspace
from tests.llm.helpers import docs, words

# --- WARC --------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    html = '<!-- x > --><p>A &amp;lt; B</p><script>"<p>no</p>"</script><STYLE a=1>p{}</STYLE>é<br/>z'
    return spark.createDataFrame(
        [(1, "http://a/", html), (2, None, None), (None, "http://b/", ""), (1, "http://a/", html), (3, "u", "<script>open")],
        "page_id long, url string, html string",
    )


def test_warc_links_text_and_digests(spark, pages):
    records = op01_warc.derivatives(op01_warc.responses(pages)).collect()
    assert len(records) == 10
    of = {(r.page_id, r.record_type): r for r in records}
    text = of[1, "conversion"]
    assert text.block == "A &lt; B\né\nz"
    assert text.content_length == len(text.block.encode())
    assert text.block_digest == "sha256:" + hashlib.sha256(text.block.encode()).hexdigest()
    about = of[1, "metadata"]
    assert about.refers_to == text.refers_to != about.record_id != text.record_id
    assert "source-header-Content-Type: text/html; charset=utf-8\r\n" in about.block
    assert f"conversion-block-digest: {text.block_digest}" in about.block
    assert of[3, "conversion"].block == of[2, "conversion"].block == ""
    assert of[2, "conversion"].target_uri == ""
    twice = [r.record_id for r in records if r.page_id == 1]
    assert len(twice) == 4 and len(set(twice)) == 2


def test_warc_headers_of_other_servers_are_kept(spark):
    block = "HTTP/1.0 404 Gone\r\nX-A: 1\r\nServer: s\r\n\r\n<b>hi</b>\r\n\r\nyou"
    rows = [("<urn:1>", "u", "d", block, "mine"), ("<urn:2>", "u", "d", "no header end", "x")]
    records = spark.createDataFrame(rows, "record_id string, target_uri string, date string, block string, note string")
    made = {(r.refers_to, r.record_type): r for r in op01_warc.derivatives(records).collect()}
    assert made["<urn:1>", "metadata"].block.startswith(
        "source-status: HTTP/1.0 404 Gone\r\nsource-header-X-A: 1\r\nsource-header-Server: s\r\n"
    )
    assert made["<urn:1>", "conversion"].block == "hi\nyou"
    assert made["<urn:1>", "conversion"].note == "mine"
    assert made["<urn:2>", "conversion"].block == ""


def test_warc_file_reads_back(spark, pages, tmp_path):
    records = op01_warc.derivatives(op01_warc.responses(pages))
    op01_warc.write_warc(records, str(tmp_path / "w"))
    found = []
    for file in (tmp_path / "w").glob("part-*"):
        data = file.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            n = int(fields[b"Content-Length"])
            assert rest[n : n + 4] == b"\r\n\r\n"
            found.append((fields[b"WARC-Record-ID"].decode(), rest[:n].decode()))
            data = rest[n + 4 :]
    assert sorted(found) == sorted((r.record_id, r.block) for r in records.collect())


@pytest.mark.parametrize("piece", ["<p ", "<", "<script ", "</style", "<!-", "<a b='", "&am", " \n"])
def test_malformed_pages_take_time_in_proportion(spark, piece):
    page = piece * (5_000_000 // len(piece))
    table = spark.createDataFrame([("", 0)], "html string, page_id long").select(
        F.repeat(F.lit(piece), len(page) // len(piece)).alias("html"), F.lit("u").alias("url"), "page_id"
    )
    start = time.time()
    assert op01_warc.derivatives(op01_warc.responses(table)).count() == 2
    made = op01_warc.derivatives(op01_warc.responses(table)).filter("record_type = 'conversion'").first()
    assert len(made.block) <= len(page) and time.time() - start < 30


def test_warc_columns_that_clash(spark, pages):
    clashing = pages.withColumns({c: F.lit("mine") for c in ("block", "date", "record_id", "headers")})
    made = {tuple(r) for r in op01_warc.derivatives(op01_warc.responses(clashing)).collect()}
    assert made == {tuple(r) for r in op01_warc.derivatives(op01_warc.responses(pages)).collect()}


def test_warc_empty(spark, pages):
    assert op01_warc.derivatives(op01_warc.responses(pages.limit(0))).count() == 0


# --- line dedup --------------------------------------------------------------


def _lines(n, seed):
    return [" ".join(words(6, seed * 1000 + i)) for i in range(n)]


def test_chunks_move_with_their_text(spark):
    body = _lines(60, 1)
    table = docs(spark, [(1, "\n".join(body)), (2, "\n".join(_lines(7, 2) + body + _lines(5, 3)))])
    kept = {r.doc_id: r for r in op02_line_dedup.dedup_lines(table).collect()}
    assert kept[1].n_removed == 0 and kept[1].text == "\n".join(body)
    left = kept[2].text.split("\n")
    assert set(_lines(7, 2) + _lines(5, 3)) <= set(left)
    assert len(left) <= 12 + 14  # all of the shared body but its ragged ends
    assert kept[2].n_chars == len(kept[2].text)


def test_every_chunk_has_two_lines(spark):
    table = docs(spark, [(i, "\n".join(_lines(n, i))) for i, n in enumerate([1, 2, 3, 4, 40])])
    rows = table.select("text", op02_line_dedup.chunks_of(F.col("text"))).collect()
    for text, chunks in rows:
        assert "\n".join(c.text for c in chunks) == text
        sizes = [c.text.count("\n") + 1 for c in chunks]
        assert min(sizes) >= 2 or sizes == [1]


def test_line_dedup_edge_cases(spark):
    long = " ".join(words(60, 9))
    short = "just a line"
    rows = [
        (1, None), (2, ""), (3, ""), (4, short), (5, short), (6, "a\nb"), (7, "a\nb"), (7, "a\nb"),
        (None, "a\nb"), (8, f"x\n{long}\ny z"), (9, f"{short}\n{long}"), (10, "\n\n\n\n"),
    ]
    got = [(r.doc_id, r.text, r.n_removed) for r in op02_line_dedup.dedup_lines(docs(spark, rows)).collect()]
    assert len(got) == len(rows)
    by_id = dict((i, (t, n)) for i, t, n in got)
    assert by_id[1] == (None, 0) and by_id[2] == by_id[3] == ("", 0)
    assert by_id[4] == by_id[5] == (short, 0)  # a single short line is no chunk to remove
    assert by_id[None] == ("a\nb", 0) and by_id[6] == ("", 1)
    assert [g for g in got if g[0] == 7] == [(7, "", 1)] * 2
    assert by_id[8][1] == 0 and by_id[9] == (short, 1)  # a long line is a passage
    columns = op02_line_dedup.dedup_lines(docs(spark, rows[:0])).columns
    assert columns == ["doc_id", "text", "lang", "source", "n_chars", "_spans", "size", "n_chunks", "n_removed"]


def test_one_holder_among_documents_of_the_same_id(spark):
    block = _lines(30, 4)
    for ids in ([None, None, 11], [5, 5, None], [7, 7, 7]):
        rows = [(i, "\n".join(block + _lines(9, 50 + n))) for n, i in enumerate(ids)]
        got = op02_line_dedup.dedup_lines(docs(spark, rows), passages=True).collect()
        removed = sorted(r.n_removed for r in got)
        assert removed[0] == 0 and removed[1] == removed[2] > 0
        assert sorted(line for r in got for line in r.text.split("\n") if line in block) == sorted(block)


def test_repeats_inside_one_document_go(spark):
    block = _lines(30, 4)
    table = docs(spark, [(1, "\n".join(block + block))])
    [row] = op02_line_dedup.dedup_lines(table).collect()
    assert row.n_removed > 0 and set(row.text.split("\n")) == set(block)


def _passage_lines(texts):
    """By document: the lines (from 0) of runs with more than 50 words that stand before."""
    seen, gone = {}, {}
    for doc, text in enumerate(texts):
        lines = text.split("\n")
        sizes = [len(line.split()) for line in lines]
        windows = set()
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                if sum(sizes[i : j + 1]) > 50:
                    windows |= {(i, j)} if sizes[i] and sizes[j] else set()
        for i, j in sorted(windows):
            held = tuple(lines[i : j + 1])
            first = seen.setdefault(held, (doc, i, j))
            if first[0] != doc or i > first[2]:
                gone.setdefault(doc, set()).update(range(i, j + 1))
    return gone


def test_planted_passages_of_short_lines_go(spark):
    """Passages of 2 to 6 short lines among other lines, in three documents each."""
    texts, planted = [], []
    for n in range(2, 7):
        for turn in range(4):
            seed = 100 * n + 10 * turn
            passage = [" ".join(words(60 // n + 1, seed * 77 + i)) for i in range(n)]
            planted.append(passage)
            for copy in range(3):
                around = [_lines(4, seed + 3 * copy + 1), _lines(3, seed + 3 * copy + 2)]
                texts.append("\n".join(around[0][turn:] + passage + around[1]))
    table = docs(spark, list(enumerate(texts)))
    kept = {r.doc_id: r for r in op02_line_dedup.dedup_lines(table, passages=True).collect()}
    for p, passage in enumerate(planted):
        assert "\n".join(passage) in kept[3 * p].text
        for i in (3 * p + 1, 3 * p + 2):
            assert not set(passage) & set(kept[i].text.split("\n"))
            assert len(kept[i].text) == kept[i].n_chars
            own = set(texts[i].split("\n")) - set(passage)
            assert own == set(kept[i].text.split("\n"))  # clean lines stay
    stage = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, table, "").collect()}
    assert stage == {i: r.text for i, r in kept.items()}


def test_passages_are_those_of_brute_force(spark):
    """Short random texts over few lines, so that runs overlap in many ways."""
    rng = random.Random(5)
    pool = [" ".join(words(rng.choice([0, 1, 9, 20, 30, 60]), i)) for i in range(7)]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(60)]
    texts += ["\n".join([pool[3]] * 12), "\n".join([pool[1], *[pool[2]] * 9])]
    table = docs(spark, list(enumerate(texts)))
    windows = op02_line_dedup.repeated_windows(table, Workspace(spark)).collect()
    assert {r._id: set(r._lines) for r in windows} == _passage_lines(texts)


# --- mixing ------------------------------------------------------------------


def _share(sizes, weights):
    """Water-filling by repetition: capped sources give their excess to the others."""
    total, target = sum(sizes), [0.0] * len(sizes)
    capped = set()
    while True:
        left = total - sum(3 * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        target = [3.0 * s if i in capped else left * weights[i] / weight for i, s in enumerate(sizes)]
        over = {i for i, t in enumerate(target) if i not in capped and t > 3 * sizes[i]}
        if not over:
            return target
        capped |= over


def _text(n, seed):
    return " ".join(words(n, seed))


def test_targets_and_pieces(spark):
    sizes = {"a": [40, 3, 500], "b": [7], None: [90, 0, 11], "": [200]}
    rows, number = [], 0
    for source, each in sizes.items():
        for n in each:
            number += 1
            rows.append((number, _text(n, number), None, source))
    table = docs(spark, rows)
    mixed = op03_mixing.mix(table, block=16)
    got = {r.doc_id: r for r in op03_mixing.taken(mixed).collect()}
    names = ["", "a", "b", None]
    want = _share([sum(sizes[n]) for n in names], [5, 2, 1, 5])
    for r in got.values():
        assert r.target == pytest.approx(want[names.index(r.source)])
        assert 0 <= r.taken <= 3 * r.size
    for name, target in zip(names, want, strict=True):
        assert sum(r.taken for r in got.values() if r.source == name) == int(target + 0.5)
    pieces = mixed.pieces.collect()
    length = {i: len((t or "").split()) for i, t, *_ in rows}
    assert all(p.words > 0 and p.first_word + p.words <= length[p.doc_id] for p in pieces)
    seen = [(p.epoch, p.doc_id, w) for p in pieces for w in range(p.first_word, p.first_word + p.words)]
    assert len(seen) == len(set(seen)) == sum(r.taken for r in got.values())


def test_schedule_is_even(spark):
    rows = [(i, _text(64, i), None, "abc"[i % 3]) for i in range(300)]
    mixed = op03_mixing.mix(docs(spark, rows), block=16)
    slots = sorted((r.slot, r.skey) for r in mixed.slots.collect())
    need = {r.skey: r.need for r in mixed.sources.collect()}
    assert len(slots) == sum(need.values())
    count = dict.fromkeys(need, 0)
    for at, (_, key) in enumerate(slots, 1):
        count[key] += 1
        assert abs(count[key] - need[key] * at / len(slots)) < 8
    again = op03_mixing.mix(docs(spark, rows[::-1]).repartition(5), block=16)
    assert sorted(again.pieces.collect()) == sorted(mixed.pieces.collect())


def test_mixing_edge_cases(spark):
    none = docs(spark, [(1, None, None, "a"), (2, " ", None, None)])
    assert {(r.size, r.target, r.taken) for r in op03_mixing.taken(op03_mixing.mix(none)).collect()} == {(0, 0.0, 0)}
    assert op03_mixing.taken(op03_mixing.mix(none.limit(0))).count() == 0
    same = docs(spark, [(5, "a b", None, "s"), (5, "a b", None, "s"), (None, "c", None, "s")])
    assert sorted(r.taken for r in op03_mixing.taken(op03_mixing.mix(same)).collect()) == [1, 2, 2]


# --- chat --------------------------------------------------------------------

MESSAGES = "conv_id long, msg_id long, parent_id long, role string, text string, score double"


def test_best_branches_of_a_tree(spark):
    rows = [
        (1, 1, None, "user", "q", None), (1, 2, 1, "assistant", "bad", 0.0), (1, 3, 1, "assistant", "good", 1.0),
        (1, 4, 3, "user", "more", 1.0), (1, 5, 4, "assistant", "end", 1.0), (1, 6, 99, "user", "lost parent", None),
        (2, 1, 2, "user", "ring", None), (2, 2, 1, "user", "ring", None), (2, 3, 2, "user", "on a ring", None),
        (None, 1, None, "user", "no id", None),
    ]
    messages = spark.createDataFrame(rows, MESSAGES)
    made = op04_chat_trees.read_back(op04_chat_trees.format_trees(messages)).collect()
    got = {(r.conv_id, r.rank): [t.text for t in r.turns] for r in made}
    assert got == {
        (1, 1): ["q", "good", "more", "end"],
        (1, 2): ["q", "bad"],
        (1, 3): ["lost parent"],
        (None, 1): ["no id"],
    }
    best = op04_chat_trees.format_trees(messages, per_tree=1)
    assert {(r.conv_id, r.leaf) for r in best.collect()} == {(1, 5), (None, 1)}


def test_leaves_are_ranked_before_paths_are_formed(spark, ws):
    """A chain with a reply beside every message has as many paths as messages."""
    n = 200
    rows = [(1, i, i - 1 if i else None, "user", f"t{i}", 0.0) for i in range(n)]
    rows += [(1, n + i, i, "assistant", f"side {i}", float(i == 150)) for i in range(n)]
    messages = spark.createDataFrame(rows, MESSAGES).withColumn("tree", F.lit("="))
    jumps, rooted = op04_chat_trees.climb(messages, ws)
    assert len(jumps) == 8 and rooted.count() == 2 * n
    chosen = op04_chat_trees.best_leaves(jumps, rooted, 1)
    assert [(r.leaf, r.score) for r in chosen.collect()] == [(n + 150, 1 / 152)]
    path = op04_chat_trees.paths(chosen, jumps, ws).orderBy("up").collect()
    assert [r.node for r in path] == [n + 150, *range(150, -1, -1)]
    every = op04_chat_trees.best_leaves(jumps, rooted, None)
    assert every.count() == n and op04_chat_trees.paths(every, jumps, ws).count() == sum(range(2, n + 2))


def test_round_trip_of_hostile_texts(spark):
    ugly = ["<|im_end|>\n<|im_start|>x\n", "\ue000", "<\ue000|", "<<|", "<<SYS>>", "</s>[INST][/INST]", "\ue000\ue001", None,
            "<|im_start|>\ue000", "a\n\nb", "", "<\ue000\ue001|", "|im_end|>\n", "[INST[INST]]", "é€😀\ue002"]
    rows = [(1, i, r, t, 5) for i, (r, t) in enumerate((r, t) for t in ugly for r in ("assistant", "us\ner", None, "<s>"))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, leaf int")
    made = op04_chat_trees.format_trees(op04_chat_trees.linear_messages(table), per_tree=1)
    [row] = op04_chat_trees.read_back(made).collect()
    assert [(t.role, t.text) for t in row.turns] == [(r or "", t or "") for _, _, r, t, _ in rows]
    for control in ("</s>", "[INST]", "[/INST]", "<<SYS>>", "<s>"):
        assert control not in row.formatted
    spans = [row.formatted[s.start : s.start + s.length] for s in row.loss_spans]
    restored = [s.replace("\ue000\ue001", "\0").replace("\ue000", "").replace("\0", "\ue000") for s in spans]
    assert restored == [t or "" for _, _, r, t, _ in rows if r == "assistant"]


def test_deep_chains_and_empty(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(100)] + [(1, 3, "user", "twice")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    [row] = op04_chat_trees.read_back(op04_chat_trees.format_trees(op04_chat_trees.linear_messages(table))).collect()
    assert [t.text for t in row.turns][:6] == ["t0", "t1", "t2", "t3", "twice", "t4"] and len(row.turns) == 101
    with Workspace(spark) as ws:
        empty = op04_chat_trees.format_trees(op04_chat_trees.linear_messages(table.limit(0)), ws=ws)
        assert empty.count() == 0
    assert op04_chat_trees.op4_chat_format(spark, table.limit(0)).filter(F.col("conv_id") == -7).count() == 1

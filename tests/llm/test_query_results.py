"""The registered queries against plain-Python versions over the smallest tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import duckdb
import pandas as pd
import pyarrow.parquet as pq
import pytest
import sentencepiece
import xxhash

from __spark_entry__ import queries
from test_audit_substrings_spelling import _spelt, _variants
from wharf.llm import html_extraction, pieces, quality_rules, tokenizers
from wharf.llm.queries import QUERIES
from wharf.llm.sql import OP5

SF = "/root/testdata/sf0.001"


def table(name: str) -> list[dict]:
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# --- pages ------------------------------------------------------------------------


class SecondParser(HTMLParser):
    """The blocks of the article element, by the parser of the standard library."""

    def __init__(self) -> None:
        super().__init__()
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1", "h2", "ul", "li", "div"):
            self.blocks.append("")
        if tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1", "h2", "ul", "li", "div"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_html_extraction_equals_a_second_parser(spark):
    got = {r.page_id: r for r in queries()["op1_html_extraction"](spark, SF).collect()}
    assert len(got) == len(table("pages"))
    for page in table("pages"):
        parser = SecondParser()
        parser.feed(page["html"])
        want = "\n".join(" ".join(b.split()) for b in parser.blocks if b.strip())
        row = got[page["page_id"]]
        assert (row.url, row.text, row.n_chars) == (page["url"], want, len(want))


@pytest.mark.parametrize(
    "page, want",
    [
        ("<html><head><title>t</title><body><p>Hello, world, this is it.</p>", ["Hello, world, this is it."]),
        ("<html><head><title>t</title><p>No body, no end of the head.</p>", ["No body, no end of the head."]),
        (
            "<body><form id=aspnet action=x><nav>Menu</nav><div><p>Long text, of an article.</p><p>More, of it.</p></div>"
            "<select><option>Pick</option></select><button>Go</button></form>",
            ["Long text, of an article.", "More, of it."],
        ),
        ("<p title=it's>FIRST</p><p>it's SECOND</p><p>THIRD</p>", ["FIRST", "it's SECOND", "THIRD"]),
        ("<p title='a>b' data-x=\"c>d\" y = 'e>f'>ONE</p><p alt=\"open>TWO</p>", ["ONE", "TWO"]),
        (
            "<article><p>Text, that stays, of course.</p><form><p>Your, name, please</p></form><p>And, its end.</p></article>",
            ["Text, that stays, of course.", "And, its end."],
        ),
    ],
)
def test_articles_that_are_easily_lost(page, want):
    assert html_extraction.main_text(page).split("\n") == want


@pytest.mark.parametrize(
    "page",
    [
        "<div>t " * 100_000,
        "<span>t " * 100_000,
        "<b><i>" * 50_000 + "</p></b></x>" * 50_000,
        "<div class=sidebar>t " * 50_000,
        "<ul><li>" * 30_000 + "<li>x" * 30_000,
        "<a href='" * 20_000,
    ],
)
def test_time_grows_with_the_page(page):
    import time

    start = time.process_time()
    html_extraction.main_text(f"<body>{page}")
    assert time.process_time() - start < 4


# --- documents --------------------------------------------------------------------


def test_sharding(spark):
    got = queries()["op2_sharding"](spark, SF).collect()
    texts = {d["doc_id"]: (d["text"] or "").encode() for d in table("documents")}
    assert len(got) == len(texts)
    for r in got:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id]))
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))


def test_sentencepiece(spark):
    got = {r.doc_id: r for r in queries()["op3_sentencepiece"](spark, SF).collect()}
    library = sentencepiece.SentencePieceProcessor(model_proto=tokenizers.read(tokenizers.PIECES))
    for d in table("documents"):
        text = (d["text"] or "").replace(pieces.SPACE, " ")
        row = got[d["doc_id"]]
        assert row.round_trip and row.decoded_sha256 == sha(text)
        if "  " not in text and "\n" not in text and not text.startswith(" "):
            ids = library.encode(text)
            assert (row.n_tokens, row.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))


def test_a_batch_is_encoded_once():
    last, made = {}, []
    batches = [pd.Series(["a", None]), pd.Series(["a", None]), pd.Series(["a", "b"]), pd.Series([], dtype=object)]
    for texts in batches:
        got = pieces.once_per_batch(last, texts, lambda: made.append(len(texts)) or pd.Series(list(texts)))
        assert list(got) == list(texts)
    assert made == [2, 2, 0]


def test_chat_formatting(spark):
    got = {r.conv_id: r for r in queries()["op4_chat_formatting"](spark, SF).collect()}
    spoken = "</s>[INST] ok [/INST]"
    said = [*table("conversations"), *({"conv_id": -1, "turn": t, "role": r, "text": spoken} for t, r in enumerate(("user", "assistant")))]
    by_id: dict[int, list[dict]] = {}
    for turn in sorted(said, key=lambda t: (t["conv_id"], t["turn"])):
        by_id.setdefault(turn["conv_id"], []).append(turn)
    assert set(got) == set(by_id)
    for conv_id, turns in by_id.items():
        row = got[conv_id]
        loss = "".join(t["text"] or "" for t in turns if t["role"] == "assistant")
        told = "".join(f"{t['role']}\n{t['text'] or ''}\n" for t in turns)
        assert (row.n_turns, row.turns_sha256) == (len(turns), sha(told))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))
        assert row.formatted_chars > sum(len(t["text"] or "") for t in turns)


def test_held_out_labels_are_not_read(spark, tmp_path):
    """Other labels on the rows that are held out change no score."""
    documents, labels = pq.read_table(f"{SF}/documents.parquet"), table("labels")
    scored = []
    for flip in (False, True):
        folder = tmp_path / f"flip-{flip}"
        folder.mkdir()
        pq.write_table(documents, folder / "documents.parquet")
        changed = [
            {**r, "quality": 1 - r["quality"] if flip and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 else r["quality"]}
            for r in labels
        ]
        pq.write_table(pq.read_table(f"{SF}/labels.parquet").schema.empty_table().from_pylist(changed), folder / "labels.parquet")
        scored.append({r.doc_id: r for r in queries()["op6_quality_classifier"](spark, str(folder)).collect()})
    assert {k: tuple(r) for k, r in scored[0].items()} == {k: tuple(r) for k, r in scored[1].items()}
    right = 0
    held = [r for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    for row in scored[0].values():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    right = sum(scored[0][r["doc_id"]].predicted == r["quality"] for r in held)
    assert held and right >= 0.9 * len(held)


def cut_bytes(documents: list[tuple[int, str]]) -> list[tuple[int, bytes, list[bool]]]:
    """(id, bytes, which of them go) by looking every 100-byte string up."""
    seen: set[bytes] = set()
    out = []
    for doc_id, text in sorted(documents, key=lambda d: d[0]):
        data = (text or "").encode()
        gone = [False] * len(data)
        for at in range(len(data) - 99):
            digest = hashlib.blake2b(data[at : at + 100], digest_size=16).digest()
            if digest in seen:
                gone[at : at + 100] = [True] * 100
            seen.add(digest)
        out.append((doc_id, data, gone))
    return out


def test_suffix_dedup(spark):
    got = {r.doc_id: r for r in queries()["op7_suffix_dedup"](spark, SF).collect()}
    for doc_id, data, gone in cut_bytes([(d["doc_id"], d["text"]) for d in table("documents")]):
        row = got[doc_id]
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        assert (row.n_bytes, row.n_removed, row.n_spans) == (len(data), sum(gone), spans)
        assert row.kept_sha256 == sha(bytes(b for b, g in zip(data, gone) if not g))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def fingerprint(text: str | None) -> int:
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words_of(text)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_simhash(spark):
    got = {r.doc_id: r for r in queries()["op8_simhash"](spark, SF).collect()}
    prints = {d["doc_id"]: fingerprint(d["text"]) for d in table("documents")}
    group = {i: i for i in prints}
    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 4 and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {i: new if g == old else g for i, g in group.items()}
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{p:016x}", group[i]) for i, p in prints.items()}


def test_spelling_variants(spark):
    counts: Counter = Counter()
    for d in table("documents"):
        counts.update(_spelt(d["doc_id"], run) for run in re.findall("[A-Za-zÀ-ÿ]+", d["text"] or ""))
    want = _variants({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})
    got = queries()["op13_spelling_variants"](spark, SF).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_every_query_has_a_version_to_compare_with():
    """Those with SQL are compared in test_llm_queries, the others here."""
    import test_llm_queries

    here = {"op1", "op2", "op3", "op4", "op6", "op7", "op8", "op13"}
    assert here | {n.split("_")[0] for n in test_llm_queries.SQL} == {n.split("_")[0] for n in QUERIES}


# --- pipeline -----------------------------------------------------------------------


def rejected(text: str | None) -> bool:
    values = dict(zip(quality_rules.MEASURES, quality_rules.measure_text(text)))
    n, lines = values["n_words"], values["n_lines"]
    return (
        n < 50
        or 100 * values["n_repeat_words"] > 50 * n
        or 4 * values["n_symbols"] > n
        or 10 * values["n_dup_lines"] > 3 * lines
        or not 2 * n <= values["word_chars"] <= 20 * n
    )


def similar(a: set, b: set) -> bool:
    return 5 * len(a & b) >= 4 * len(a | b)


def whole_characters(data: bytes, gone: list[bool]) -> str:
    """The characters of which a byte is left; a character that is only touched stays."""
    out, at = [], 0
    while at < len(data):
        end = at + 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        if not all(gone[at:end]):
            out.append(data[at:end])
        at = end
    return b"".join(out).decode()


def test_pipeline_equals_a_plain_fold(spark):
    docs = [d for d in table("documents") if not rejected(d["text"])]

    sets = []
    for d in docs:
        words = (d["text"] or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if group[a] != group[b] and similar(sets[a], sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    best: dict[int, int] = {}
    for i, g in enumerate(group):
        if g not in best or docs[i]["doc_id"] < docs[best[g]]["doc_id"]:
            best[g] = i
    docs = [docs[i] for i in best.values()]
    assert len(docs) < len(group)

    cuts = cut_bytes([(d["doc_id"], d["text"]) for d in docs])
    texts = {doc_id: whole_characters(data, gone) for doc_id, data, gone in cuts}
    assert any(any(gone) for _, _, gone in cuts)
    docs = [{**d, "text": texts[d["doc_id"]], "n_chars": len(texts[d["doc_id"]])} for d in docs]

    con = duckdb.connect()
    columns = {name: [d[name] for d in docs] for name in ("doc_id", "source", "text")}
    import pyarrow as pa

    con.register("documents", pa.table(columns))
    mixed = con.execute(OP5.replace("* size)::BIGINT AS taken", ")::BIGINT AS taken")).fetchall()
    copies = {row[0]: row[4] for row in mixed}
    assert set(copies) == set(texts) and max(copies.values()) == 2

    library = sentencepiece.SentencePieceProcessor(model_proto=tokenizers.read(tokenizers.PIECES))
    want = Counter()
    for d in docs:
        n = len(library.encode(d["text"].replace(" ", pieces.SPACE)))
        want[(d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"])] += copies[d["doc_id"]]
        assert n > 0 or not d["text"]
    want = +want
    got = queries()["pipeline"](spark, SF).collect()
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in got) == want
    raw = pieces.Pieces(tokenizers.read(tokenizers.PIECES)).raw
    for r in got:
        assert r.n_tokens == len(r.ids)
        assert pieces.decode_bytes(raw, r.ids) == r.text.replace(pieces.SPACE, " ")

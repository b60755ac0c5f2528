"""Each operator against a brute-force version, over rows that are hard to handle."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from wharf.llm import (
    chat,
    golay,
    html_extraction,
    mixing,
    pieces,
    quality_model,
    quality_rules,
    sharding,
    shingles,
    simhash,
    suffix_dedup,
    tokenizers,
    topk,
)
from wharf.llm.common import prepare
from wharf.llm.components import components

SCHEMA = "doc_id bigint, text string, source string, lang string, fp string, slot int, k string, n_words int"


def _texts() -> list[str | None]:
    rnd = random.Random(5)
    words = ["tide", "Ölweg", "grain", "moss", "über", "quartz", "lantern", "sled", "漢字", "wove"]

    def prose(n: int) -> str:
        return " ".join(rnd.choice(words) + str(rnd.randrange(40)) for _ in range(n))

    base, passage = prose(120), prose(30)
    near = base.replace(base.split()[60], "changed", 1)
    return [
        base,
        base,
        near,
        None,
        "",
        "  \n\t ",
        "one",
        "\n".join(["same line here"] * 30),
        prose(40) + "\n" + passage + "\n" + prose(30),
        passage + prose(25),
        prose(20) + passage,
        "### $$$ %%% " * 30,
        prose(3000),
        "a" * 400,
        "x y" + "z" * 150 + "a" * 130,
    ]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, f"s{i % 3}" if i % 5 else None) for i, t in enumerate(_texts())]
    out.append(out[1])  # a repeated row
    out.append((None, _texts()[0], "s1"))  # no id
    out.append((2, "another text with the same id " * 8, "s2"))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(*r, "en", "clash", 7, "key", 1) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# --- HTML extraction ----------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
<body><header>Site</header><nav><ul><li><a href=/a>A</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies, really, all of them.</div><article><h1>Head &amp; line</h1>
<p><b>Bold start<br>second  line<p>Caf&eacute; text, with &#8364; signs, and
more.<form><input><p>Sign up</p></form><aside>Aside</aside>
<section><ul><li>one<li>two</ul></section></article>
<section id="comments"><p>I disagree, strongly, with all, of, this, at length.</p></section>
<div class=sidebar>More</div><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_page():
    want = "Head & line\nBold start second line\nCafé text, with € signs, and more.\none\ntwo"
    assert html_extraction.main_text(PAGE) == want


def test_pages_without_an_article_element():
    page = "<body><div class=menu><a>x</a></div><div><p>Long, enough, text.</p><p>More of it.</p></div><p>By</p>"
    assert html_extraction.main_text(page) == "Long, enough, text.\nMore of it."


LONG = "<p>First, a paragraph of the article, long enough to score.</p><p>Second, and more, of it.</p>"


@pytest.mark.parametrize(
    "open_tag",
    [
        "<div class='content has-sidebar'>",
        "<div id='page' class='no-sidebar'>",
        "<div class='entry social-share'>",
        "<article class='post has-comments'>",
        "<section id='related-work'>",
        "<div class=sidebar><article>",
        "<div id=discussion>",
    ],
)
def test_names_do_not_cost_the_article(open_tag):
    page = f"<body><div class='menu-top'>Menu, a, b</div>{open_tag}{LONG}"
    want = ["First, a paragraph of the article, long enough to score.", "Second, and more, of it."]
    assert html_extraction.main_text(page).split("\n") == want


def test_names_still_mark_what_is_around():
    around = "<div class='sidebar-left'>Links, and, more</div><div class='page__cookie-notice'>We, use, cookies</div>"
    cards = "<div class=related><article><p>Another, story</p></article></div>"
    talk = "<div id=comments>" + "<article class=comment-body><p>No, no, no, and, no.</p></article>" * 9 + "</div>"
    page = f"<body>{around}<article>{LONG}<h2 id=discussion>Discussion</h2><p>Why, and how.</p></article>{cards}{talk}"
    got = html_extraction.main_text(page).split("\n")
    assert len(got) == 4 and got[2:] == ["Discussion", "Why, and how."]


def test_broken_pages(spark):
    prepare(spark)
    cases = [(1, None), (2, ""), (3, "<p>cut <b>of"), (4, "plain &am"), (4, "plain &am"), (5, "<a href='x>y"), (6, "<!-- open")]
    df = spark.createDataFrame([(*c, "t") for c in cases], "page_id int, html string, text string")
    got = {(r.page_id, r.text, r.n_chars) for r in html_extraction.extract(df).collect()}
    assert {(1, "", 0), (2, "", 0), (3, "cut of", 6), (4, "plain &am", 9), (6, "", 0)} <= got
    assert html_extraction.extract(df.limit(0)).count() == 0


# --- sharding -------------------------------------------------------------------


def test_shards_are_exact_and_gapless(spark, docs, empty):
    out = sharding.shard(docs, 4, seed=1).collect()
    assert Counter(Counter(r.shard for r in out).values()) in ({4: 2, 5: 2}, {5: 2, 4: 2})
    for shard in range(4):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert _plain((r.doc_id, r.text) for r in out) == _plain((r.doc_id, r.text) for r in docs.collect())
    assert sharding.shard(empty, 4).count() == 0


def test_matrix_margins_and_spread(spark):
    parts = spark.range(40).select(F.col("id").alias("part"), (F.col("id") * 3 + 1).alias("n"))
    total = sum(3 * i + 1 for i in range(40))
    sizes = [total // 3, total // 3, total - 2 * (total // 3)]
    drawn = []
    for seed in range(3):
        got = {r.part: r.counts for r in sharding.communication_matrix(parts, sizes, seed).collect()}
        assert {p: sum(c) for p, c in got.items()} == {i: 3 * i + 1 for i in range(40)}
        assert [sum(c[j] for c in got.values()) for j in range(3)] == sizes
        drawn += [c[0] - (3 * p + 1) / 3 for p, c in got.items() if p > 20]
    assert abs(np.mean(drawn)) < 2 and 2 < np.std(drawn) < 7  # about sqrt(n * 2 / 9)


def test_hypergeometric_frequencies(spark):
    u = (F.col("id") + 0.5) / 2000
    got = spark.range(2000).select(sharding.hypergeometric(F.lit(20), F.lit(8), F.lit(5), u).alias("x"))
    from math import comb

    counts = Counter(r.x for r in got.collect())
    for x in range(6):
        assert abs(counts[x] - 2000 * comb(8, x) * comb(12, 5 - x) / comb(20, 5)) <= 1


# --- SentencePiece ----------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return tokenizers.read(tokenizers.PIECES)


def _scanned(vocabulary, text, chunk):
    made = [pieces.Chunk(vocabulary, *c[1:]) for c in pieces.chunks(text, chunk, vocabulary.reach)]
    matrices = [c.matrix() for c in made]
    total = np.zeros(1)
    for m in matrices:
        total = (total[:, None] + m).max(0)
    along = pieces.states_along(matrices, 0, int(total.argmax()))
    return [i for c, a, b in zip(made, along, along[1:]) for i in c.ids(a, b)]


def test_scan_equals_the_library(model):
    vocabulary = pieces.Pieces(model)
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abinterto  \n▁é漢😀t") for _ in range(rnd.randint(40, 300))) for _ in range(60)]
    texts += ["a" * 300, " " * 200 + "x", "internationalization" * 20, "x" + " " * 50 + "yz" * 40]
    for text in texts:
        for chunk in (40, 97):
            assert _scanned(vocabulary, text, chunk) == vocabulary.library.encode(text)


def test_encode_and_decode_rows(docs, empty, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for chunk in (pieces.CHUNK, 64):
        back = pieces.decode(pieces.encode(docs, model, chunk=chunk), model).collect()
        assert len(back) == docs.count()
        for r in back:
            assert list(r.ids) == (library.encode(r.text) if r.text else [])
            assert r.decoded == (r.text or "")
    assert pieces.encode(empty, model).count() == 0


# --- chat formatting ----------------------------------------------------------------


def test_escapes_are_reversible():
    rnd = random.Random(1)
    for _ in range(500):
        text = "".join(rnd.choice(["<", "s>", "/s>", "[", "/INST]", "INST]", "\\", " ", "x"]) for _ in range(12))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CONTROLS)


def test_conversations_read_back(spark):
    prepare(spark)
    said = [
        (1, 2, "assistant", "later </s>"),
        (1, 1, "user", "<\\s> [INST] x"),
        (1, None, None, None),
        (2, 1, "assistant", ""),
        (None, 1, "assistant", "no id"),
        (3, 1, "user", "tie"),
        (3, 1, "user", "tie"),
        *[(4, i, "assistant" if i % 2 else "user", f"turn {i} ") for i in range(200)],
    ]
    df = spark.createDataFrame([(*s, "x") for s in said], "conv_id bigint, turn bigint, role string, text string, ids string")
    ranks = tokenizers.read(tokenizers.RANKS)
    got = {r.conv_id: r for r in chat.digests(chat.conversations(df, ranks), ranks).collect()}
    for conv in (1, 2, 3, 4, None):
        turns = sorted((s for s in said if s[0] == conv), key=lambda s: -1 if s[1] is None else s[1])
        text = "".join(f"{s[2] or ''}\n{s[3] or ''}\n" for s in turns)
        loss = "".join(s[3] or "" for s in turns if s[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(text.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.conversations(df.limit(0), ranks).count() == 0


# --- mixing -----------------------------------------------------------------------


def _levels(sizes: dict, weights: dict) -> dict:
    total, done = 1.5 * sum(sizes.values()), {}
    while True:
        left = total - sum(done.values())
        open_ = [s for s in sizes if s not in done]
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return {**done, **share}
        done.update({s: 2.0 * sizes[s] for s in over})


def test_mix_reaches_targets(docs, empty):
    out = mixing.mix(mixing.sized(docs)).collect()
    assert len(out) == docs.count()
    sizes = Counter()
    for r in out:
        assert r.size == len((r.text or "").encode().split())
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        sizes[r.source] += r.size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goals = _levels(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    for source in sizes:
        mine = [r for r in out if r.source == source]
        assert mine[0].target == pytest.approx(goals[source])
        assert abs(sum(r.taken for r in mine) - goals[source]) <= max(r.size for r in mine) / 2 + 1
    again = mixing.mix(mixing.sized(docs.repartition(5))).collect()
    assert _plain((r.doc_id, r.text, r.taken) for r in again) == _plain((r.doc_id, r.text, r.taken) for r in out)
    assert mixing.mix(mixing.sized(empty)).count() == 0


def test_mix_of_a_source_full_of_symbols(spark, monkeypatch):
    """Low weights push all keys far out; buckets still hold like numbers of rows."""
    prepare(spark)
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 10)
    made = [(i, "code" if i % 2 else "prose", 10 + i % 7, 0.016 if i % 2 else 1.0) for i in range(2000)]
    df = spark.createDataFrame(made, "doc_id int, source string, size int, weight double").repartition(3)
    sizes = []
    whole = mixing.exclusive_prefix
    monkeypatch.setattr(
        mixing,
        "exclusive_prefix",
        lambda d, *a: sizes.extend(r["count"] for r in d.groupBy("source_key", "__bucket").count().collect()) or whole(d, *a),
    )
    out = mixing.mix(df).collect()
    assert len(out) == 2000 and max(sizes) < 60 and len(sizes) > 200
    for source in ("code", "prose"):
        mine = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 16


# --- clashing names --------------------------------------------------------------------

NAMES = (
    "part row shard slot id n k v fp at r c h key source_key source size weight component_id cell far digest mask "
    "failures __row __at __key __rank __bucket __before __size __least __root __one __again __block __ends held"
).split()


@pytest.mark.parametrize(
    "operator, made",
    [
        (lambda d: sharding.shard(d, 3), {"shard", "slot"}),
        (lambda d: mixing.mix(d, weight="heavy", size="words"), set()),
        (lambda d: simhash.near_duplicates(d.withColumn("fp", simhash.fingerprints("text"))), {"component_id", "fp"}),
        (shingles.keep_one, set()),
        (lambda d: suffix_dedup.deduplicate(d), set()),
        (lambda d: html_extraction.extract(d, "html", "main"), set()),
        (lambda d: quality_rules.ledger(d.withColumn("t", F.col("text")), "t"), {"failures"}),
        (lambda d: pieces.encode(d, tokenizers.read(tokenizers.PIECES)), set()),
        (lambda d: quality_model.statistics(d.withColumn("t", F.col("text")), "t"), set()),
    ],
)
def test_other_columns_come_back_unchanged(spark, operator, made):
    """Every name used inside or made by some operator, as a column of the input."""
    prepare(spark)
    rows_ = [(i, f"text number {i} of some words", 8, 1.0, f"<p>{i}") for i in range(6)]
    df = spark.createDataFrame(rows_, "doc_id int, text string, words int, heavy double, html string")
    names = [n for n in NAMES if n not in df.columns]
    df = df.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id")).alias(n) for n in names])
    out = operator(df)
    kept = [n for n in names if n not in made]
    assert set(kept) <= set(out.columns) and len(out.columns) == len(set(out.columns))
    got = {tuple(r) for r in out.select("doc_id", *[F.col(f"`{n}`") for n in kept]).collect()}
    assert got == {(i, *(f"{n}-{i}" for n in kept)) for i in range(6)}


# --- quality ------------------------------------------------------------------------


def test_measures_of_texts(docs, empty):
    for r in quality_rules.apply_policy(quality_rules.ledger(docs.withColumn("t", F.col("text")), "t"), "v2").collect():
        words = (r.text or "").encode().split()
        seen = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        again = {i + d for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for d in range(3)}
        assert (r.n_words, r.n_repeat_words) == (len(words), len(again))
        assert r.word_chars == sum(len(w.decode()) for w in words)
        lines = [x for x in (r.text or "").split("\n") if x.encode().split()]
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "")
        if len(words) < 50 or 100 * len(again) > 50 * len(words):
            assert not r.kept
    assert quality_rules.ledger(empty).count() == 0
    assert quality_rules.keep(docs).columns == docs.columns


def test_ablation_counts(docs):
    entries = quality_rules.ledger(docs)
    bits = [r.failures & quality_rules.mask_of(quality_rules.POLICIES["v1"]) for r in entries.collect()]
    by_name = {rule.name: 1 << rule.bit for rule in quality_rules.rules()}
    for r in quality_rules.ablation(entries, "v1").collect():
        bit = by_name[r.rule]
        assert r.n_failed == sum(b & bit > 0 for b in bits)
        assert r.n_alone == bits.count(bit)
        assert r.n_kept_without == sum(b & ~bit == 0 for b in bits)


def test_classifier_learns_rules(spark, docs, empty):
    rnd = random.Random(2)
    made = []
    for i in range(120):
        junk = i % 3 == 0
        made.append((i, " ".join(rnd.choice(["sun", "moon", "tide"]) + ("###" if junk else "") for _ in range(60)), int(not junk)))
    df = spark.createDataFrame(made, "doc_id bigint, text string, label int")
    model = quality_model.fit(quality_model.statistics(df))
    assert 0 < len(model.weighted) < 60
    scored = quality_model.statistics(docs.drop("fp")).withColumn("score", model.score())
    assert scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    own = quality_model.statistics(df).withColumn("score", model.score()).collect()
    assert all((r.score >= 0.5) == (r.label == 1) for r in own)
    none = quality_model.statistics(empty).withColumn("label", F.lit(1))
    assert quality_model.fit(none) == quality_model.Constant(0.5)


# --- repeated substrings ----------------------------------------------------------------


def _removed(documents: list[tuple]) -> dict:
    """(bytes, removed, runs, kept digest) per distinct document, window by window."""
    seen: set[bytes] = set()
    out = {}
    for key in sorted(set(documents), key=lambda d: (d[0] is not None, d[0] or 0, hashlib.md5((d[1] or "").encode()).hexdigest())):
        data = (key[1] or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot_rows", [suffix_dedup.HOT_ROWS, 1])
@pytest.mark.parametrize("odd_ids", [True, False])
def test_repeated_substrings_leave(docs, rows, hot_rows, odd_ids):
    df = docs if odd_ids else docs.where("doc_id IS NOT NULL AND doc_id != 2").distinct()
    listed = [(r.doc_id, r.text) for r in df.collect()]
    want = _removed(listed)
    out = suffix_dedup.deduplicate(df, hot_rows=hot_rows).collect()
    assert len(out) == len(listed)
    for r in out:
        cut = r["__cut"]
        got = (cut.n_bytes, cut.n_removed, cut.n_spans, hashlib.sha256(cut.kept).hexdigest())
        assert got == want[r.doc_id, r.text]
        assert "�" not in (cut.text or "")


@pytest.mark.parametrize("hot_rows", [suffix_dedup.HOT_ROWS, 1])
def test_a_document_listed_twice_keeps_its_text(spark, hot_rows):
    prepare(spark)
    alone = " ".join(f"only{i} here" for i in range(40))
    listed = [(1, alone), (1, alone), (2, "x" + alone[:150]), (3, "too short")]
    want = _removed(listed)
    assert want[1, alone][1] == 0
    for r in suffix_dedup.deduplicate(spark.createDataFrame(listed, "doc_id bigint, text string"), hot_rows=hot_rows).collect():
        cut = r["__cut"]
        assert (cut.n_bytes, cut.n_removed, cut.n_spans, hashlib.sha256(cut.kept).hexdigest()) == want[r.doc_id, r.text]


def test_no_documents_to_deduplicate(empty):
    assert suffix_dedup.deduplicate(empty).count() == 0


# --- near-duplicates --------------------------------------------------------------------


def test_golay_keys_meet_within_two_bits():
    made = golay.tables()
    rnd = np.random.default_rng(1)
    words = rnd.integers(0, 1 << 23, 300)
    for a in range(23):
        for b in range(a, 23):
            other = words ^ (1 << a) ^ ((1 << b) if b != a else 0)
            left, right = golay.keys(words, made), golay.keys(other, made)
            met = ((left[:, :, None] == right[:, None, :]) & (left[:, :, None] >= 0)).any((1, 2))
            assert met.all()


def test_links_connect_all_close_fingerprints():
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 1 << 63, 40, dtype=np.int64)
    near = [b ^ int(sum(1 << int(p) for p in rnd.choice(63, 4, replace=False))) for b in base for _ in range(6)]
    fps = np.unique(np.concatenate([base, np.array(near, np.int64)]))
    keys, at = simhash.fuzzy_keys(fps, golay.tables())
    a, b = simhash.forest_links(keys, fps[at])
    root = {int(f): int(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        root[find(x)] = find(y)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count((fps[i] ^ fps).view(np.uint64)) <= 4):
            assert find(int(fps[i])) == find(int(fps[j]))


def _print(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_near_duplicate_groups(docs, empty):
    made = docs.select("doc_id", "text", simhash.fingerprints("text").alias("fp"))
    out = simhash.near_duplicates(made).collect()
    prints = [(r.doc_id, _print(r.text)) for r in docs.collect()]
    assert {(r.doc_id, r.fp & (1 << 64) - 1) for r in out} == set(prints)
    for r in out:
        group = {r.fp & (1 << 64) - 1}
        while True:
            more = {f for _, f in prints if any((f ^ g).bit_count() <= 4 for g in group)}
            if more <= group:
                break
            group |= more
        assert r.component_id == min(i for i, f in prints if f in group and i is not None)
    nothing = empty.select("doc_id", simhash.fingerprints("text").alias("fp"))
    assert simhash.near_duplicates(nothing).count() == 0


def test_hot_keys_are_compared_in_pairs_of_blocks(spark):
    """Fingerprints of a template: many distinct ones share a key, few of them are linked."""
    prepare(spark)
    rnd = random.Random(6)
    base = rnd.getrandbits(64)
    made = {base ^ (rnd.getrandbits(21) << 43) for _ in range(400)} | {rnd.getrandbits(64) for _ in range(50)}
    made |= {f ^ (1 << rnd.randrange(64)) for f in list(made)[:40]}
    signed = [f - (1 << 64) if f >> 63 else f for f in made]
    df = spark.createDataFrame([(f,) for f in signed], "fp bigint")
    whole = {r.node: r.root for r in components(simhash.links(df)).collect()}
    for hot_rows in (7, 100):
        cut = {r.node: r.root for r in components(simhash.links(df, hot_rows=hot_rows)).collect()}
        assert cut == whole and whole


def test_components_of_a_long_path(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(links.unionAll(spark.range(1).selectExpr("500L a", "600L b"))).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(1, 201)} | {(600, 500)}


def _copies(rnd: random.Random) -> list[tuple]:
    """Near copies from few to many changes, a common passage, and rows that are hard to handle."""
    words = [f"w{i}" for i in range(500)]
    passage = rnd.choices(words, k=30)
    made = []
    for g in range(8):
        base = rnd.choices(words, k=90)
        for n in range(30 if g == 0 else 4):
            text = list(base)
            for _ in range(rnd.randint(0, 4)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            made.append(" ".join(text[rnd.randint(0, 12) :]))
    made += [" ".join(passage + rnd.choices(words, k=k)) for k in (0, 2, 5, 9, 40, 60, 60, 60)]
    made += [made[0].upper().replace(" ", "\n"), made[40], None, "", " ", "one two", "one  two", "one two three four five"]
    rnd.shuffle(made)
    return [(i, t) for i, t in enumerate(made)] + [(None, made[3]), (None, "no id " * 30), (7, made[7]), (9, "other text " * 9)]


def test_near_duplicates_by_similarity(spark, empty):
    prepare(spark)
    listed = _copies(random.Random(8))
    sets = []
    for _, text in listed:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))})
    root = list(range(len(listed)))
    for a in range(len(listed)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    want = []
    for g in set(root):
        ids = [listed[j][0] for j in range(len(listed)) if root[j] == g]
        want.append(min((i for i in ids if i is not None), default=None))
    df = spark.createDataFrame([(*r, "clash") for r in listed], "doc_id bigint, text string, v string").repartition(3)
    kept = shingles.keep_one(df)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(want)
    assert shingles.keep_one(empty).count() == 0


def test_pairs_of_a_template_grow_with_its_rows(spark, monkeypatch):
    """Rows that share most buckets but are not similar: pairs per row do not grow."""
    prepare(spark)
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = rnd.choices(words, k=120)

    def candidates(size: int) -> int:
        made = []
        for i in range(size):
            text = list(base)
            for at in rnd.sample(range(120), 5):
                text[at] = f"x{i}y{at}"
            made.append((i, " ".join(text)))
        df = spark.createDataFrame(made, "v bigint, text string").repartition(3)
        counts = []
        whole = shingles._Groups.verify
        monkeypatch.setattr(shingles._Groups, "verify", lambda self, p: counts.append(p.distinct().count()) or whole(self, p))
        shingles.links(df)
        monkeypatch.setattr(shingles._Groups, "verify", whole)
        return sum(counts)

    assert candidates(240) < 24 * 240


def test_recall_against_all_pairs(spark):
    prepare(spark)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    by_set = {shingles.shingles(r.text).tobytes(): (r.doc_id, r.text) for r in rows}
    listed = [(i, t, shingles.shingles(t)) for i, t in by_set.values()]
    df = spark.createDataFrame([(i, t) for i, t, _ in listed], "v bigint, text string")
    root = {r.v: r.c for r in shingles.links(df).collect()}
    pairs = [
        (a[0], b[0])
        for n, a in enumerate(listed)
        for b in listed[:n]
        if 9 * len(np.intersect1d(a[2], b[2], assume_unique=True)) >= 4 * (len(a[2]) + len(b[2]))
    ]
    caught = sum(root.get(a, a) == root.get(b, b) for a, b in pairs)
    assert pairs and caught >= 0.9 * len(pairs)


def test_the_pipeline_drops_copies_that_fingerprints_keep(spark):
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(900)}" for _ in range(200)]
    texts = [" ".join("new" if j in spots else w for j, w in enumerate(base)) for spots in ((), (30, 90, 150), (50, 110, 180))]
    bits = [(simhash.fingerprint(texts[0]) ^ simhash.fingerprint(t)).bit_count() for t in texts[1:]]
    assert min(bits) > simhash.MOST_BITS
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()] == [0]


# --- top-k ----------------------------------------------------------------------------


@pytest.mark.parametrize("pivots, block", [(4, 7), (64, 2048)])
def test_top_k_is_exact(spark, pivots, block):
    prepare(spark)
    rnd = np.random.default_rng(3)
    vectors = [(i, rnd.integers(-2, 3, 4).astype(float).tolist()) for i in range(60)]
    vectors += [(60 + i, [0.5, 0.25, -0.125, 1.0]) for i in range(30)]
    bad = [(90, None), (91, [1.0, None, 0.0, 0.0]), (92, [float("nan"), 0.0, 0.0, 0.0]), (93, [float("inf")] * 4)]
    rest = [(94, []), (95, [1.0]), (None, [9.0] * 4), (0, vectors[0][1]), (96, [1e30, -1e30, 1e30, 0.0])]
    df = spark.createDataFrame([(*v, 1) for v in vectors + bad + rest], "vec_id bigint, embedding array<double>, cell int")
    got = topk.search(df, F.col("vec_id") % 10 == 0, 5, pivots=pivots, block=block).collect()
    good = [v for v in vectors + rest if v[0] is not None]
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in good]
    want = set()
    for q, v in dict(whole).items():
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])}
    assert {(r.query_id, r.rank, r.vec_id, max(min(r.score, 1 << 63), -(1 << 63))) for r in got} == {
        (q, n, i, max(min(s, (1 << 63) - 1), 1 - (1 << 63))) for q, n, i, s in want
    }
    assert topk.search(df.limit(0), F.lit(True), 5).count() == 0


def test_query_groups_are_neighbours_of_about_a_block():
    centres = [np.array([x], np.float64).tobytes() for x in (0, 100, 1, 101, 50)]
    groups, parts = topk.query_groups(centres, {0: 4, 1: 5, 2: 3, 3: 4, 4: 25}, 10)
    assert parts == {0: 1, 1: 1, 2: 1, 3: 1, 4: 3}
    assert groups[0] == groups[2] and groups[1] == groups[3]
    assert len({groups[0], groups[1], groups[4]}) == 3
    assert topk.query_groups(centres, {}, 10) == ({}, {})
    together, _ = topk.query_groups(centres, {c: 1 for c in range(5)}, 10)
    assert set(together.values()) == {0}


def test_fingerprint_does_not_depend_on_the_word_blocks(monkeypatch):
    rng = random.Random(5)
    parts = ["a", "B", " ", "\n", "\t", "\x0b", "\x1c", "é", " ", "word"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 90))) for _ in range(300)]
    whole = [simhash.fingerprint(t) for t in texts]
    for size in (1, 2, 7):
        monkeypatch.setattr(simhash, "WORDS_AT_ONCE", size)
        assert [simhash.fingerprint(t) for t in texts] == whole


def test_what_is_stored_in_passing_is_removed(spark, tmp_path):
    from pathlib import Path

    from wharf.llm.common import scratch, stored
    from wharf.session import shared_folder

    def folders():
        return {p.name for p in (Path(shared_folder(spark).removeprefix("file:")) / "wharf").glob("passing-*")}

    before = folders()
    with scratch(spark) as keep:
        inner = stored(spark.range(5), "passing-inner")
        with scratch(spark) as deeper:
            result = deeper(inner.where("id > 2"), "passing-result")
            stored(inner, "passing-deep")
        assert len(folders() - before) == 2
        result = keep(result, "passing-kept")
    assert [n.rsplit("-", 1)[0] for n in folders() - before] == ["passing-kept"]
    assert result.count() == 2
    with pytest.raises(RuntimeError):
        with scratch(spark):
            stored(spark.range(1), "passing-failed")
            raise RuntimeError
    assert len(folders() - before) == 1


def test_near_duplicates_of_a_large_bucket_are_found(spark):
    """Variants of one template share large buckets only; two of them are linked to each other."""
    template = " ".join(f"t{i}" for i in range(200))

    def variant(name: str, own: int) -> str:
        return template + " " + " ".join(f"{name}x{i}" for i in range(own))

    texts = [variant(f"v{n}", 30) for n in range(250)]
    texts += [variant("p", 22), variant("q", 22)]
    sets = [set(shingles.shingles(t).tolist()) for t in texts]
    rows = [(n, t) for n, t in enumerate(texts)]
    linked = {
        (a, b)
        for a in range(len(texts))
        for b in range(a)
        if 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b]))
    }
    assert linked == {(251, 250)}
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    kept = {r.doc_id for r in shingles.keep_one(df).select("doc_id").collect()}
    assert kept == set(range(251))


def test_parities_lose_no_similar_pair():
    """Sets differ in as many shingles as cells, or more; halves fold into the parities for fewer cells."""
    draw = np.random.default_rng(5)
    for n in (0, 1, 16, 17, 100, 1000, 20_000):
        whole = np.unique(draw.integers(0, 1 << 63, n + n // 4, dtype=np.uint64))
        left, right = whole[:n], whole[n // 8 :]
        mine, other = shingles.parities(left), shingles.parities(right)
        assert 4 * n <= 64 * len(mine) <= max(8 * n, 64)
        while len(mine) > len(other):
            mine = mine[: len(mine) // 2] ^ mine[len(mine) // 2 :]
        while len(other) > len(mine):
            other = other[: len(other) // 2] ^ other[len(other) // 2 :]
        differ = int(np.bitwise_count((mine ^ other).view(np.uint64)).sum())
        apart = len(np.setxor1d(left, right))
        assert differ <= apart and differ % 2 == apart % 2
        assert 5 * differ >= 4 * apart


def test_what_is_left_of_a_large_bucket_makes_few_pairs(spark, monkeypatch):
    """Variants that are like each other, but not linked, are not paired with each other."""
    template = " ".join(f"t{i}" for i in range(200))

    def variant(name: str, own: int) -> str:
        return template + " " + " ".join(f"{name}x{i}" for i in range(own))

    texts = [variant(f"v{n}", 45) for n in range(150)]
    # Two that are linked, and two of them with parities of different lengths.
    texts += [variant("p", 22), variant("q", 22)]
    long = " ".join(f"u{i}" for i in range(250))
    texts += [long + " " + " ".join(f"{n}y{i}" for i in range(120)) for n in range(100)]
    texts += [long, long + " " + " ".join(f"z{i}" for i in range(40))]
    sizes = {len(shingles.parities(shingles.shingles(t))) for t in texts[-2:]}
    assert len(sizes) == 2
    counts = []
    whole = shingles._Groups.rest_pairs

    def counted(self, rows):
        pairs = whole(self, rows)
        counts.append(pairs.count())
        return pairs

    monkeypatch.setattr(shingles._Groups, "rest_pairs", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    kept = {r.doc_id for r in shingles.keep_one(df).select("doc_id").collect()}
    assert kept == set(range(len(texts))) - {151, 253}
    assert sum(counts) <= len(texts)

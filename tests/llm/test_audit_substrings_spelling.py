"""Filter audit, substring removal and spelling variants against plain-Python versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wharf.llm import filter_audit, spelling, substring_dedup
from wharf.llm.common import prepare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = "part string, mask int, at bigint, k bigint, word string, n bigint, row string, cut string"


def _texts() -> list[str | None]:
    rnd = random.Random(11)
    vocabulary = ["tide", "Ölweg", "grain", "moss", "über", "quartz", "lantern", "sled", "漢字", "wove"]

    def prose(n: int) -> str:
        return " ".join(rnd.choice(vocabulary) + str(rnd.randrange(60)) for _ in range(n))

    base, passage, short = prose(260), prose(30), prose(13)
    return [
        base,
        base,
        base.replace(" ", "\n\t "),
        base.replace(base.split()[130], "changed"),
        None,
        "",
        " \n\x0b",
        "one",
        passage + " " + prose(40),
        prose(7) + " " + passage,
        prose(20) + " " + passage + " " + prose(20) + " " + passage,
        short,
        short + " and more",
        " ".join(short.split()[1:]),
        "same " * 500,
        "same " * 40 + "end",
        "LOUD TEXT WITH # " * 80,
        " x  " + prose(230),
        prose(3000) + " " + passage + " " + "x" * 3000,
    ]


@pytest.fixture(scope="module")
def rows():
    out = [(100 - i if i % 2 else i, t, "en" if i % 3 else (None, "")[i % 2]) for i, t in enumerate(_texts())]
    out.append(out[3])  # a repeated row
    out.append((None, _texts()[0], "de"))
    out.append((None, "without id " + _texts()[8], "de"))
    out.append((out[9][0], "the same id again " + _texts()[9], "fr"))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    prepare(spark)
    wide = [(*r, "p", 3, 1, 2, "w", 9, "r", "c") for r in rows]
    return spark.createDataFrame(wide, f"doc_id bigint, text string, lang string, {CLASH}").repartition(3)


# --- filter audit -----------------------------------------------------------------


def _failures(rows):
    least: dict[str, int] = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and least[text] < i,
        }
        out.append((i, lang or "", {f for f, failed in fails.items() if failed}))
    return out


def test_audit_equals_running_every_order(spark, docs, rows):
    labels = [(i, i % 2, i % 3 == 0) for i in range(100)] + [(0, 1, False), (2, None, None), (None, 1, True)]
    known = spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in labels], "doc_id bigint, quality int, toxic int")
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t and i is not None}
    masked = filter_audit.masks(docs, known)
    lost = {"good_lost": F.col("good"), "toxic_lost": F.col("toxic")}
    got = {(r.part, r.filter_order, r.step): r for r in filter_audit.audit(masked, "ABCDE", lost).collect()}
    judged = _failures(rows)
    assert len(got) == 600 * len({part for _, part, _ in judged})
    shapley = Counter()
    for part in {part for _, part, _ in judged}:
        for order in permutations("ABCDE"):
            left = [d for d in judged if d[1] == part]
            gone: list = []
            for step, f in enumerate(order, 1):
                out = [d for d in left if f in d[2]]
                row = got[part, "".join(order), step]
                assert row.removed == len(out) and row.redundant == sum(f in d[2] for d in gone)
                assert row.good_lost == sum(d[0] in good for d in out)
                assert row.toxic_lost == sum(d[0] in toxic for d in out)
                assert row.unique_fails == sum(d[1] == part and d[2] == {f} for d in judged)
                left = [d for d in left if f not in d[2]]
                gone += out
                assert row.kept == len(left)
                shapley[part, f] += len(out)
    assert all(r.shapley == shapley[part, order[step - 1]] for (part, order, step), r in got.items())


def test_audit_of_other_filters_and_of_nothing(spark, docs):
    rows = spark.createDataFrame([("p", 3, 5), ("p", 1, 7), ("q", 0, 1)], "part string, mask int, size int")
    got = filter_audit.audit(rows, "xy", {"size": F.col("size")}).where("part = 'p' AND filter_order = 'yx'")
    assert [(r.step, r.kept, r.removed, r.size, r.shapley) for r in got.orderBy("step").collect()] == [
        (1, 1, 1, 5, 1),
        (2, 0, 1, 7, 3),
    ]
    with pytest.raises(ValueError):
        filter_audit.audit(rows, ["x", "x"], {})
    empty = docs.limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(filter_audit.masks(empty, labels), "ABCDE", {}).count() == 0


def test_words_are_counted_over_blocks(monkeypatch):
    data = ("ab  cd\tab\n" * 50 + "é x").encode()
    whole = filter_audit.word_counts(data)
    monkeypatch.setattr(filter_audit, "BLOCK", 4)
    assert filter_audit.word_counts(data) == whole == (152, 4)


# --- substring removal ------------------------------------------------------------


def _cuts(rows):
    last = 1 << 63
    listed = [(last if i is None else i, WORD.findall(t or "")) for i, t, _ in rows]
    least: dict[tuple, int] = {}
    for rank, words in listed:
        for j in range(len(words) - 12):
            w = tuple(words[j : j + 13])
            least[w] = min(rank, least.get(w, rank))
    out = []
    for (i, _, _), (rank, words) in zip(rows, listed):
        gone = [False] * len(words)
        for j in range(len(words) - 12):
            if least[tuple(words[j : j + 13])] < rank:
                gone[j : j + 13] = [True] * 13
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [0, 2, substring_dedup.HOT_ROWS])
def test_removed_words_equal_brute_force(docs, rows, hot_rows):
    out = substring_dedup.deduplicate(docs, hot_rows=hot_rows)
    got = out.select("row.doc_id", "cut.n_words", "cut.n_removed", "cut.kept").collect()
    assert sorted((tuple(r) for r in got), key=repr) == _cuts(rows)
    boxed = out.select("row.*").collect()
    assert sorted(map(repr, boxed)) == sorted(map(repr, docs.collect()))


def test_surroundings_are_folded_a_part_at_a_time(monkeypatch):
    """Long documents: the rows are those of the whole, but for what is folded across parts."""
    import pyarrow as pa

    text = (" ".join(_texts()[18].split()[:400]) + " ") * 3
    _, prefix = substring_dedup.anchors(substring_dedup.word_hashes(text.encode()))
    wanted = np.unique(prefix).view(np.int64).tolist()
    columns = [pa.array([b"d" * 16]), pa.array([5]), pa.array([text.encode()]), pa.array([wanted], pa.list_(pa.int64()))]
    batch = pa.RecordBatch.from_arrays(columns, ["d", "r", "text", "hs"])
    told = []
    for size in (1 << 16, 7):
        monkeypatch.setattr(substring_dedup, "FOLDED", size)
        rows_ = [r for b in substring_dedup._suffixes(iter([batch])) for r in b.to_pylist()]
        told.append(sorted((r["words"], r["before"], at) for r in rows_ for at in np.frombuffer(r["at"], np.int64).tolist()))
    assert told[0] == told[1] and len(told[0]) > 100


def test_spans_are_maximal_runs(spark):
    prepare(spark)
    words = [f"w{i}" for i in range(60)]
    later = ["x", *words[:20], "y", *words[20:40], "z"]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(later))], "doc_id int, text string")
    got = {r.row.doc_id: r.cut for r in substring_dedup.deduplicate(df).collect()}
    assert got[1].n_removed == 0 and got[1].spans == []
    assert [tuple(s) for s in got[2].spans] == [(1, 21), (22, 42)] and got[2].kept == "x y z"
    assert substring_dedup.deduplicate(df.limit(0)).count() == 0


def test_random_documents_of_few_words(spark):
    prepare(spark)
    rnd = random.Random(3)
    # A small alphabet makes ties of anchors, repeats within documents and shared edges common.
    made = [" ".join(rnd.choices("ab", [9, 1], k=rnd.randrange(5, 90))) for _ in range(60)]
    rows = [(rnd.randrange(30), t, None) for t in made]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    for hot_rows in (5, 50_000):
        out = substring_dedup.deduplicate(df, hot_rows=hot_rows)
        got = out.select("row.doc_id", "cut.n_words", "cut.n_removed", "cut.kept").collect()
        assert sorted((tuple(r) for r in got), key=repr) == _cuts(rows)


def test_anchors_do_not_depend_on_blocks(monkeypatch):
    hashes = np.random.default_rng(1).integers(0, 50, 3000, dtype=np.uint64)
    whole = substring_dedup.anchors(hashes)
    monkeypatch.setattr(substring_dedup, "BLOCK", 17)
    parts = substring_dedup.anchors(hashes)
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))
    # Every window of 13 words holds an anchor, of eight words.
    held = np.isin(np.arange(3000), whole[0])
    assert all(held[i : i + 6].any() for i in range(3000 - 12))


# --- spelling ---------------------------------------------------------------------


def _spelt(i, run):
    run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
    h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
    return run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :])


def _variants(words):
    near = defaultdict(list)
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) <= 1 and _one_edit(a, b):
                near[a].append(b)
    form = {}
    for a in words:
        best = min(near[a], key=lambda b: (-words[b], b), default=None)
        if best is not None and words[best] >= 5 * words[a]:
            form[a] = best

    def root(a):
        while a in form:
            a = form[a]
        return a

    return sorted(
        ((a, form.get(a), root(a), words[a], len(near[a]), words[form[a]] if a in form else None) for a in words),
        key=repr,
    )


@pytest.mark.parametrize("candidates", [1, 40, spelling.CANDIDATES])
def test_variants_equal_brute_force(spark, candidates):
    prepare(spark)
    rnd = random.Random(7)
    words: dict[str, int] = {}
    # Common beginnings and endings, short alphabets, repeats of a letter, long words, accents.
    for _ in range(500):
        head, tail = rnd.choice(["contra", "über", "aaaaaa", "x"]), rnd.choice(["tionen", "aaaa", "é", "ing"])
        middle = "".join(rnd.choices("abé", k=rnd.randrange(0, 6)))
        word = head + middle + tail
        if len(word) >= 6:
            words[word] = rnd.choice([5, 6, 30, 31, 160, 900, 900, 5000])
    for _ in range(80):
        word = rnd.choice(list(words))
        at = rnd.randrange(len(word))
        words.setdefault(word[:at] + rnd.choice("abq") + word[at + rnd.randrange(2) :], 5)
    words["z" * 4000] = 5
    words["z" * 1999 + "y" + "z" * 2001] = 25
    words = {w: n for w, n in words.items() if len(w) >= 6}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = spelling.variants(df, candidates).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _variants(words)


def test_chains_of_forms_are_followed_to_their_end(spark):
    prepare(spark)
    words = {"aaaaaa" + "b" * i: 5 ** (i + 1) for i in range(9)}
    got = spelling.variants(spark.createDataFrame(list(words.items()), "word string, n bigint")).collect()
    assert {r.root for r in got} == {"aaaaaa" + "b" * 8}
    assert sum(r.form is None for r in got) == 1


def test_vocabulary_of_hard_rows(spark, docs, rows):
    letters = "Ärger Straße NAÏVE naïve oeuvre×÷ x_longer-words ABCDEF abcdef ÀÀÀÀÀÀ " * 9
    more = [(7, letters, "en"), (7, letters, "en"), (None, letters, None), (8, "İstanbul ſmall " * 30, "tr")]
    df = docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame(more, "doc_id bigint, text string, lang string")
    )
    counts: Counter = Counter()
    for i, text, _ in [*rows, *more]:
        counts.update(_spelt(i, run) for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""))
    want = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    assert {r.word: r.n for r in spelling.vocabulary(df).collect()} == want
    assert spelling.variants(spelling.vocabulary(docs.limit(0))).count() == 0


def test_runs_over_blocks(monkeypatch):
    text = "Ab cdE é×ß, " * 40
    whole = spelling.runs(text)
    monkeypatch.setattr(spelling, "BLOCK", 3)
    assert spelling.runs(text) == whole == Counter({"ab": 40, "cde": 40, "é×ß": 40})


def test_digest_of_the_words_left(spark):
    """The query's digest is over the words joined by one space."""
    prepare(spark)
    df = spark.createDataFrame([(1, " a\tb  c ")], "doc_id int, text string")
    kept = substring_dedup.deduplicate(df).select(F.sha2("cut.kept", 256).alias("d")).first().d
    assert kept == hashlib.sha256(b"a b c").hexdigest()

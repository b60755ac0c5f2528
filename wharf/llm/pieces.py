"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

The model at hand merges pieces by rank. Its encoding of a text is the one segmentation whose
neighbouring pieces are compatible, that is, whose pair is encoded as just these two. So it is
the best path of a lattice in which a piece carries its score and an incompatible step
carries minus infinity, and paths combine in the (max, +) algebra.

Texts up to ``CHUNK`` characters are encoded where they lie. A longer one is cut at fixed places. The
states of a cut are the pieces of the vocabulary that reach over it or end at it; both
neighbours read them from the characters around the cut. Each chunk yields the matrix of best
paths from its left to its right states, without knowing its neighbours. Matrices are
multiplied within blocks, the block products are scanned, and once every cut has its state the
chunks are traced back independently. Inside a chunk, no piece crosses the start of a space
run, so what lies between the first and the last of those is encoded directly; a chunk
without one is searched in full.

Defined cases: null and empty texts have no ids and decode to the empty text; characters
outside the vocabulary become bytes; the mark U+2581 stands for a space and decodes to one, all
else returns exactly; repeated rows are encoded each; an empty table stays empty; columns of
the input are kept (one named ``ids`` is replaced).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wharf.llm import tokenizers
from wharf.llm.common import stored

CHUNK = 32_768
#: Chunks whose matrices are multiplied in one group, and chunks that one task works through.
CHUNKS_PER_BLOCK = 256
CHUNKS_PER_TASK = 64
SPACE = "▁"
NEVER = -np.inf


class Pieces:
    """The vocabulary of a model file and the rule which pieces may be neighbours."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        count = self.library.get_piece_size()
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        self.raw: list[bytes] = []
        for i in range(count):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value] = i
                self.raw.append(bytes([value]))
            elif self.library.is_control(i) or self.library.is_unknown(i):
                self.raw.append(b"")
            else:
                self.id[piece], self.score[piece] = i, self.library.get_score(i)
                self.raw.append(piece.replace(SPACE, " ").encode())
        self.reach = max(map(len, self.id))
        self._pairs: dict[tuple[str, str], bool] = {}

    def merge(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best-ranked pair until none is left."""
        parts = list(text)
        while True:
            best, at = NEVER, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1], NEVER)
                if score > best:
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, a: str, b: str) -> bool:
        """Whether pieces a, b stay as they are when they meet; unknown characters always do."""
        if a not in self.id or b not in self.id:
            return self.merge(a) == [a] and self.merge(b) == [b]
        known = self._pairs.get((a, b))
        if known is None:
            if len(self._pairs) > 1_000_000:
                self._pairs.clear()
            known = self._pairs[a, b] = self.merge(a + b) == [a, b]
        return known

    def ids(self, piece: str) -> list[int]:
        found = self.id.get(piece)
        return [found] if found is not None else [self.byte[b] for b in piece.encode()]

    def starting(self, text: str, at: int) -> Iterator[str]:
        """Lattice edges from one place: pieces, or the single character."""
        for size in range(1, min(self.reach, len(text) - at) + 1):
            piece = text[at : at + size]
            if size == 1 or piece in self.id:
                yield piece

    def direct(self, marked: str) -> list[int]:
        """Ids of a marked text that starts with a space run, without any cut."""
        return self.library.encode(marked[1:]) if marked else []


State = tuple[int, str]  # start of a piece relative to the cut (negative), and the piece


def cut_states(pieces: Pieces, around: str, cut: int) -> list[State]:
    """The pieces that start before ``cut`` and end at or after it, in a fixed order."""
    out = []
    for start in range(max(0, cut - pieces.reach), cut):
        for piece in pieces.starting(around, start):
            if start + len(piece) >= cut:
                out.append((start - cut, piece))
    return out


def lattice(
    pieces: Pieces, text: str, entries: list[tuple[int, str | None]], stop: int
) -> dict[int, dict[State, tuple[np.ndarray, list]]]:
    """Best scores of all paths over ``text``, one vector entry per start.

    ``entries`` are (place, piece before it or None). Returns, per end at or after ``stop``,
    the pieces that start before it with their score vectors and predecessors.
    """
    size = len(entries)
    ending: dict[int, dict[tuple[int, str | None], tuple[np.ndarray, list]]] = {}
    for i, (place, piece) in enumerate(entries):
        vector = np.full(size, NEVER)
        vector[i] = 0.0
        ending.setdefault(place, {})[(-1 - i, piece)] = (vector, [])
    for at in range(min(ending, default=0), stop):
        if at not in ending:
            continue
        for piece in pieces.starting(text, at):
            total, back = None, []
            for before, (vector, _) in ending[at].items():
                if before[1] is None or pieces.compatible(before[1], piece):
                    total = vector if total is None else np.maximum(total, vector)
                    back.append((at, before))
            if total is not None:
                made = total + pieces.score.get(piece, 0.0)
                ending.setdefault(at + len(piece), {})[(at, piece)] = (made, back)
    return ending


def trace(ending: dict, end: int, last: tuple[int, str | None]) -> list[str]:
    """Pieces of the best path (from a single start) to one piece."""
    out: list[str] = []
    place, key = end, last
    while True:
        vector, back = ending[place][key]
        if not back:
            return out[::-1]
        out.append(key[1])
        place, key = max(back, key=lambda b: ending[b[0]][b[1]][0][0])


def barriers(text: str, low: int, high: int) -> tuple[int, int]:
    """First and last start of a space run in text[low:high], or -1, -1."""
    first = last = -1
    at = text.find(SPACE, low, high)
    while at >= 0:
        if at == 0 or text[at - 1] != SPACE:
            first = at
            break
        at = text.find(SPACE, at + 1, high)
    at = text.rfind(SPACE, low, high)
    while at >= 0:
        if at == 0 or text[at - 1] != SPACE:
            last = at
            break
        at = text.rfind(SPACE, low, at)
    return first, last


class Chunk:
    """One chunk with the characters around it. ``left`` and ``right`` are its cuts in ``text``."""

    def __init__(self, pieces: Pieces, text: str, left: int, right: int, first: bool, last: bool):
        self.pieces, self.text, self.left, self.right, self.last = pieces, text, left, right, last
        self.enter: list[State] = [(0, "")] if first else cut_states(pieces, text, left)
        self.leave = cut_states(pieces, text, right)
        if last:
            self.leave = [s for s in self.leave if s[0] + len(s[1]) == 0]
        # A run starts a fresh path; the text's first one is no cut inside.
        self.open, self.close = barriers(text, left + pieces.reach, right)

    def _entry(self, state: State) -> tuple[int, str | None]:
        start, piece = state
        return (self.left + start + len(piece), piece or None)

    def _exits(self, ending: dict, size: int) -> np.ndarray:
        out = np.full((size, len(self.leave)), NEVER)
        for j, (start, piece) in enumerate(self.leave):
            at = self.right + start
            found = ending.get(at + len(piece), {}).get((at, piece))
            if found is not None:
                out[:, j] = found[0]
        return out

    def matrix(self) -> np.ndarray:
        """Best path from every left to every right state, in (max, +)."""
        entries = [self._entry(s) for s in self.enter]
        if self.open < 0:
            return self._exits(lattice(self.pieces, self.text, entries, self.right), len(entries))
        head = lattice(self.pieces, self.text, entries, self.open)
        into = np.full(len(entries), NEVER)
        for vector, _ in head.get(self.open, {}).values():
            into = np.maximum(into, vector)
        tail = lattice(self.pieces, self.text, [(self.close, None)], self.right)
        # All paths share what lies between; it adds the same to each.
        return into[:, None] + self._exits(tail, 1)

    def _path(self, entry: tuple[int, str | None], end: int, last: State | None) -> list[str]:
        ending = lattice(self.pieces, self.text, [entry], end)
        if last is None:
            options = ending.get(end, {})
            key = max(options, key=lambda k: options[k][0][0])
            return trace(ending, end, key)
        at = self.right + last[0]
        return trace(ending, at + len(last[1]), (at, last[1]))

    def ids(self, enter: int, leave: int) -> list[int]:
        """Ids of the pieces that start in this chunk, between two known states."""
        entry, last = self._entry(self.enter[enter]), self.leave[leave]
        if self.open < 0:
            path = self._path(entry, self.right, last)
            return [i for p in path for i in self.pieces.ids(p)]
        head = self._path(entry, self.open, None)
        tail = self._path((self.close, None), self.right, last)
        out = [i for p in head for i in self.pieces.ids(p)]
        if self.close > self.open:
            out += self.pieces.direct(self.text[self.open : self.close])
        return out + [i for p in tail for i in self.pieces.ids(p)]


def marked(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


def chunks(text: str, chunk: int, reach: int) -> Iterator[tuple[int, str, int, int, bool, bool]]:
    """(number, text with surroundings, left cut, right cut, first, last) of a giant text.

    The last chunk takes the rest as well, so no piece reaches over a whole chunk.
    """
    if chunk < 2 * reach:
        raise ValueError("a chunk must hold two of the longest pieces")
    whole = marked(text)
    count = max(1, len(whole) // chunk)
    for i in range(count):
        a, b = i * chunk, (i + 1) * chunk if i < count - 1 else len(whole)
        from_, to = max(0, a - reach), min(len(whole), b + reach)
        yield i, whole[from_:to], a - from_, b - from_, i == 0, i == count - 1


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def states_along(matrices: list[np.ndarray], enter: int, leave: int) -> list[int]:
    """The state at every cut of the best path between two known ones."""
    ahead = [np.full(matrices[0].shape[0], NEVER)]
    ahead[0][enter] = 0.0
    for m in matrices:
        ahead.append((ahead[-1][:, None] + m).max(0))
    out = [leave]
    for i in range(len(matrices) - 1, -1, -1):
        out.append(int((ahead[i] + matrices[i][:, out[-1]]).argmax()))
    return out[::-1]


def _plain(m: np.ndarray) -> list[list[float]]:
    return m.tolist()


def _square(rows) -> np.ndarray:
    return np.array([list(r) for r in rows], np.float64)


def once_per_batch(last: dict, texts: pd.Series, make: Callable[[], pd.Series]) -> pd.Series:
    """What ``make`` gives for these texts, made once if they come several times in a row.

    The planner writes the encoder out at every use of its ids, and a worker then runs it as often
    over one batch, before it goes on to the next one.
    """
    if "texts" not in last or not texts.equals(last["texts"]):
        last["texts"], last["ids"] = texts, make()
    return last["ids"]


def encode(df: DataFrame, model: bytes, text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``df`` with ``ids``, the piece ids of ``text``."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # one vocabulary file
    names = [c for c in df.columns if c != "ids"]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def vocabulary() -> Pieces:
        return tokenizers.once_per_worker("pieces", lambda: Pieces(shared.value))

    @F.pandas_udf("array<int>")
    def whole_ids(texts: pd.Series) -> pd.Series:
        last = tokenizers.once_per_worker("pieces-last", dict)
        direct = vocabulary().direct
        return once_per_batch(last, texts, lambda: pd.Series([np.array(direct(marked(t)), np.int32) for t in texts]))

    columns = [F.col(f"`{c}`") for c in names]
    usual = df.where(F.length(body) <= chunk).select(*columns, whole_ids(body).alias("ids"))
    giants = stored(
        df.where(F.length(body) > chunk).select(
            F.struct(*columns).alias("__row"),
            body.alias("t"),
            F.monotonically_increasing_id().alias("key"),
        ),
        "giant-texts",
    )
    shape = "key bigint, i int, t string, l int, r int, f boolean, e boolean"

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reach = vocabulary().reach
        for frame in frames:
            for key, t in zip(frame["key"], frame["t"]):
                for part in chunks(t, chunk, reach):
                    yield pd.DataFrame([(key, *part)], columns=[c.split()[0] for c in shape.split(", ")])

    n_chunks = giants.agg(F.sum(F.ceil(F.length("t") / chunk))).first()[0] or 0
    tasks = max(1, -(-n_chunks // CHUNKS_PER_TASK))
    dealt = giants.select("key", "t").mapInPandas(split, shape).repartition(tasks, "key", "i")
    parts = stored(dealt, "chunks")

    def summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = vocabulary()
        for frame in frames:
            made = [
                _plain(Chunk(pieces, *row).matrix())
                for row in zip(frame["t"], frame["l"], frame["r"], frame["f"], frame["e"])
            ]
            yield frame[["key", "i"]].assign(block=frame["i"] // CHUNKS_PER_BLOCK, m=made)

    matrices = stored(
        parts.mapInPandas(summarise, "key bigint, i int, block int, m array<array<double>>"), "matrices"
    )

    def multiply(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("i")
        total = None
        for m in map(_square, frame["m"]):
            total = m if total is None else product(total, m)
        return pd.DataFrame({"key": frame["key"][:1], "block": frame["block"][:1], "m": [_plain(total)]})

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("block")
        blocks = [_square(m) for m in frame["m"]]
        total = np.zeros(1)
        for m in blocks:
            total = (total[:, None] + m).max(0)
        along = states_along(blocks, 0, int(total.argmax()))
        return pd.DataFrame(
            {"key": frame["key"], "block": frame["block"], "enter": along[:-1], "leave": along[1:]}
        )

    def settle(own: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("i")
        along = states_along([_square(m) for m in own["m"]], int(ends["enter"].iloc[0]), int(ends["leave"].iloc[0]))
        return pd.DataFrame({"key": own["key"], "i": own["i"], "enter": along[:-1], "leave": along[1:]})

    products = matrices.groupBy("key", "block").applyInPandas(multiply, "key bigint, block int, m array<array<double>>")
    ends = products.groupBy("key").applyInPandas(scan, "key bigint, block int, enter int, leave int")
    known = (
        matrices.groupBy("key", "block")
        .cogroup(ends.groupBy("key", "block"))
        .applyInPandas(settle, "key bigint, i int, enter int, leave int")
    )

    def retrace(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces = vocabulary()
        for frame in frames:
            ids = [
                np.array(Chunk(pieces, *row[:5]).ids(*row[5:]), np.int32)
                for row in zip(*(frame[c] for c in ("t", "l", "r", "f", "e", "enter", "leave")))
            ]
            yield frame[["key", "i"]].assign(ids=ids)

    traced = parts.join(known, ["key", "i"]).mapInPandas(retrace, "key bigint, i int, ids array<int>")
    # One row per giant text again, as large as the text itself was.
    joined = traced.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("i", "ids"))).alias("p"))
    whole = giants.join(joined, "key").select(
        *[F.col("__row").getField(c).alias(c) for c in names], F.flatten("p.ids").alias("ids")
    )
    return usual.unionByName(whole)


def decode_bytes(raw: list[bytes], ids) -> str:
    data = b"".join([raw[i] for i in ids])
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def decode(df: DataFrame, model: bytes, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` stand for."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # one vocabulary file

    @F.pandas_udf("string")
    def decoded(lists: pd.Series) -> pd.Series:
        raw = tokenizers.once_per_worker("pieces", lambda: Pieces(shared.value)).raw
        return pd.Series([decode_bytes(raw, x.tolist()) if x is not None else "" for x in lists], dtype=object)

    rest = [F.col(f"`{c}`") for c in df.columns if c != text]
    return df.select(*rest, decoded(F.col(f"`{ids}`")).alias(text))

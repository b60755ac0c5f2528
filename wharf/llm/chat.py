"""Chat formatting on the level of tokens.

The template is ``<s>`` and, for each turn, ``[INST]`` role ``[/INST]`` text ``</s>``. Role and
text of a turn are encoded separately, and the reserved ids of the four control strings are
spliced between them, so no content can ever produce a reserved id. In the text form, control
strings inside a role or a text are escaped by one more backslash after their first character,
and taking one away restores them. The loss mask (an assistant's text and its closing mark)
comes from prefix sums over the segment lengths.

Turns are encoded as rows, without any grouping. A conversation is put together in two steps,
first within blocks of turns, so a very long one reaches its last task as few rows.

Defined cases: a null or empty text is an empty segment, a null role an empty role; turns are
ordered by number (null first), equal numbers by role and then a digest of the text, repeated
rows stay repeated; rows with a null conv_id form one conversation; an empty table gives no
conversations; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wharf.llm import tokenizers

#: Control strings; their ids follow the vocabulary, in this order.
CONTROLS = ("<s>", "[INST]", "[/INST]", "</s>")
START, OPEN, CLOSE, END = range(4)
ASSISTANT = "assistant"
TURNS_PER_BLOCK = 64
_MARKED = re.compile(r"([<\[])(\\*)(?=/?s>|/?INST\])")


def _control_like(found: re.Match, change: int) -> str:
    text, at = found.string, found.end()
    tails = ("s>", "/s>") if found[1] == "<" else ("INST]", "/INST]")
    if not text.startswith(tails, at):
        return found[0]
    marks = len(found[2]) + change
    return found[1] + "\\" * max(marks, 0)


def escape(text: str) -> str:
    return _MARKED.sub(lambda m: _control_like(m, 1), text)


def unescape(text: str) -> str:
    return _MARKED.sub(lambda m: _control_like(m, -1), text)


_SEGMENT = (
    "conv_id bigint, turn bigint, role string, tie bigint, ids array<int>, head int, body int, loss boolean"
)


def segments(rows: DataFrame, ranks: bytes) -> DataFrame:
    """One row per turn: its ids with control ids spliced in, and the lengths of its parts."""
    shared = rows.sparkSession.sparkContext.broadcast(ranks)  # one vocabulary file

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = tokenizers.once_per_worker("chat", lambda: tokenizers.byte_level(shared.value))
        first = encoding.n_vocab
        for frame in frames:
            out = []
            for role, text in zip(frame["role"], frame["text"]):
                named = encoding.encode_ordinary(escape(role or ""))
                body = encoding.encode_ordinary(escape(text or ""))
                ids = [first + OPEN, *named, first + CLOSE, *body, first + END]
                out.append((np.array(ids, np.int32), len(named) + 2, len(body)))
            yield frame.assign(
                ids=[o[0] for o in out],
                head=np.array([o[1] for o in out], np.int32),
                body=np.array([o[2] for o in out], np.int32),
                loss=frame["role"] == ASSISTANT,
            ).drop(columns="text")

    narrow = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.xxhash64("text").alias("tie"),
        F.col("text").cast("string").alias("text"),
    )
    return narrow.mapInPandas(encode, _SEGMENT)


def loss_mask(heads: np.ndarray, bodies: np.ndarray, loss: np.ndarray) -> np.ndarray:
    """One byte per id: 1 on the text and closing mark of the turns with loss.

    Segment borders are the prefix sums of the lengths; the mask is the prefix sum of steps up
    and down at those borders.
    """
    turn = heads + bodies + 1
    begin = 1 + np.cumsum(turn) - turn + heads
    steps = np.zeros(2 + int(turn.sum()), np.int8)
    np.add.at(steps, begin[loss], 1)
    np.add.at(steps, (begin + bodies + 1)[loss], -1)
    return np.cumsum(steps, dtype=np.int8)[:-1]


def conversations(rows: DataFrame, ranks: bytes) -> DataFrame:
    """(conv_id, text, ids, mask): every conversation formatted, one row each."""
    block = F.coalesce(F.floor(F.col("turn") / TURNS_PER_BLOCK).cast("bigint"), F.lit(-(1 << 62)))
    order = F.struct("turn", "role", "tie", "head", "body", "loss", "ids")
    in_block = (
        segments(rows, ranks)
        .groupBy("conv_id", block.alias("block"))
        .agg(F.sort_array(F.collect_list(order)).alias("t"))
        .select(
            "conv_id",
            "block",
            F.flatten("t.ids").alias("ids"),
            F.col("t.head").alias("head"),
            F.col("t.body").alias("body"),
            F.col("t.loss").alias("loss"),
        )
    )
    whole = (
        in_block.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("block", "ids", "head", "body", "loss"))).alias("b"))
        .select("conv_id", *[F.flatten(f"b.{c}").alias(c) for c in ("ids", "head", "body", "loss")])
    )
    shared = rows.sparkSession.sparkContext.broadcast(ranks)

    def assemble(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = tokenizers.once_per_worker("chat", lambda: tokenizers.byte_level(shared.value))
        first = encoding.n_vocab
        for frame in frames:
            made = []
            for ids, head, body, loss in zip(frame["ids"], frame["head"], frame["body"], frame["loss"]):
                ids = np.concatenate([[first + START], ids]).astype(np.int32)
                mask = loss_mask(np.asarray(head), np.asarray(body), np.asarray(loss, bool))
                made.append((as_text(ids, encoding), ids, mask))
            yield pd.DataFrame(
                {
                    "conv_id": frame["conv_id"],
                    "text": [m[0] for m in made],
                    "ids": [m[1] for m in made],
                    "mask": [m[2] for m in made],
                }
            )

    return whole.mapInPandas(assemble, "conv_id bigint, text string, ids array<int>, mask array<tinyint>")


def _pieces(ids: np.ndarray, first: int) -> Iterator[tuple[int, int, int]]:
    """(control or -1, from, to) over the control ids and the runs between them."""
    marks = np.flatnonzero(ids >= first)
    at = 0
    for mark in marks.tolist():
        if mark > at:
            yield -1, at, mark
        yield int(ids[mark]) - first, mark, mark + 1
        at = mark + 1
    if at < len(ids):
        yield -1, at, len(ids)


def _decoded(encoding, ids: np.ndarray) -> str:
    return encoding.decode_bytes(ids.tolist()).decode("utf-8")


def as_text(ids: np.ndarray, encoding) -> str:
    """The text form of formatted ids."""
    return "".join(
        CONTROLS[kind] if kind >= 0 else _decoded(encoding, ids[a:b])
        for kind, a, b in _pieces(ids, encoding.n_vocab)
    )


def read_turns(ids: np.ndarray, mask: np.ndarray, encoding) -> tuple[list[tuple[str, str]], str]:
    """The turns (role, text) and all text under the mask, unescaped."""
    turns: list[list[str]] = []
    losses: list[str] = []
    inside = START
    for kind, a, b in _pieces(ids, encoding.n_vocab):
        if kind == OPEN:
            turns.append(["", ""])
        if kind >= 0:
            inside = kind
            continue
        text = unescape(_decoded(encoding, ids[a:b]))
        turns[-1][inside == CLOSE] += text
        covered = mask[a:b]
        if covered.any():
            losses.append(unescape(_decoded(encoding, ids[a:b][covered.astype(bool)])))
    return [tuple(t) for t in turns], "".join(losses)


def read_text(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted text, by its control strings alone."""
    found = re.findall(r"\[INST\](.*?)\[/INST\](.*?)</s>", text, re.S)
    return [(unescape(role), unescape(body)) for role, body in found]


def digests(formatted: DataFrame, ranks: bytes) -> DataFrame:
    """What a reader gets back from formatted conversations, as counts and digests."""
    shared = formatted.sparkSession.sparkContext.broadcast(ranks)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = tokenizers.once_per_worker("chat", lambda: tokenizers.byte_level(shared.value))
        for frame in frames:
            out = []
            for conv, text, ids, mask in zip(frame["conv_id"], frame["text"], frame["ids"], frame["mask"]):
                turns, loss = read_turns(np.asarray(ids), np.asarray(mask), encoding)
                if read_text(text) != turns:
                    raise ValueError(f"conversation {conv}: text and tokens disagree")
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append(
                    (
                        len(turns),
                        hashlib.sha256(said.encode()).hexdigest(),
                        len(loss),
                        hashlib.sha256(loss.encode()).hexdigest(),
                        len(text),
                    )
                )
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pd.concat(
                [frame[["conv_id"]].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1
            )

    return formatted.mapInPandas(
        read,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint",
    )

r"""Chat formatting at token level.

A turn becomes ``<|im_start|>``, the role, a line break, the text, ``<|im_end|>``, a line break. The two marks are
reserved ids above the vocabulary, spliced between segments that are encoded one by one, so no text can produce them.
Control strings of this and other common templates that occur in a text are escaped: a backslash goes behind
their first character, and one more where there are backslashes already, which can be undone exactly. In a role
backslashes and line breaks are escaped. The loss mask covers the texts of the trained role; it is the running sum of
a +1 at the start and a -1 at the end of each such segment.

Turns are encoded where their rows lie; conversations then meet in one shuffle, ordered by turn, and are put together
as they stream by, one at a time.

Defined results: a null text or role is empty; rows with the same turn number go by role, then text; repeated rows are
turns of their own; rows without a conversation id are one conversation with a null id; an empty table gives
an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
START_ID, END_ID = 50257, 50258
CONTROLS = [START, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|startoftext|>", "<unk>", "<pad>"]

_REST = "|".join(re.escape(c[1:]) for c in CONTROLS)
_PLAIN = re.compile(rf"([<\[])(\\*)({_REST})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_REST})")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\2\\\3", text) if "<" in text or "[" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Codec:
    """Ids of a segment and back. Byte-level, so decoding gives exactly what was encoded."""

    def __init__(self, tokenizer: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(tokenizer), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("segments", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return self.encoding.decode_bytes(ids.tolist()).decode("utf-8")


def assemble(turns: list[tuple[bytes, bytes, bool]], newline: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and loss mask of a conversation, from (ids of role and line break, ids of text, trained)."""
    start, end = np.array([START_ID], "<u4"), np.array([END_ID], "<u4")
    segments, flags = [], []
    for head, body, trained in turns:
        segments += [start, np.frombuffer(head, "<u4"), np.frombuffer(body, "<u4"), end, newline]
        flags += [False, False, trained, False, False]
    stops = np.cumsum([len(s) for s in segments])
    change = np.zeros(stops[-1] + 1, np.int32)
    own = np.flatnonzero(flags)
    np.add.at(change, stops[own - 1], 1)
    np.add.at(change, stops[own], -1)
    return np.concatenate(segments), np.cumsum(change[:-1]).astype(np.uint8)


def format(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant", tokenizer: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Per conversation: its id, ``n_turns``, ``ids`` (little-endian 32-bit numbers) and ``mask`` (a byte for each id)."""
    rows = conversations.select(
        F.col(id).alias("id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    kind, order = conversations.schema[id].dataType, rows.schema["turn"].dataType
    encoded = T.StructType([T.StructField("id", kind), T.StructField("turn", order), *T._parse_datatype_string("role string, text_key string, head binary, body binary").fields])
    out = T.StructType([T.StructField(id, kind), *T._parse_datatype_string("n_turns long, ids binary, mask binary").fields])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(tokenizer)
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            heads = [codec.encode(escape_role(r) + "\n").tobytes() for r in roles]
            bodies = [codec.encode(escape(t)).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(heads, pa.binary()), pa.array(bodies, pa.binary())], names=encoded.names)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        newline = Codec(tokenizer).encode("\n")
        id_type: list[pa.DataType] = []

        def turns() -> Iterator[tuple]:
            for b in batches:
                id_type[:] = [b.schema.field(0).type]
                yield from zip(*(b.column(c).to_pylist() for c in (0, 2, 4, 5)), strict=True)

        def sent(done: list[tuple]) -> pa.RecordBatch:
            kinds = (id_type[0], pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in done], k) for c, k in enumerate(kinds)], names=out.names)

        done, size = [], 0
        for conv, own in groupby(turns(), key=lambda r: r[0]):
            held = [(head, body, who == trained) for _, who, head, body in own]
            ids, mask = assemble(held, newline)
            done.append((conv, len(held), ids.tobytes(), mask.tobytes()))
            size += 5 * len(ids)
            if size > 1 << 20:
                yield sent(done)
                done, size = [], 0
        if done:
            yield sent(done)

    return rows.mapInArrow(encode, encoded).repartition("id").sortWithinPartitions("id", "turn", "role", "text_key").mapInArrow(join, out)


def parse(ids: np.ndarray, mask: np.ndarray, codec: Codec) -> tuple[list[tuple[str, str]], list[str], str]:
    """Back from a formatted conversation: its turns (role, text), the texts under the mask, and the formatted text."""
    turns, learned, shown = [], [], []
    starts, ends = np.flatnonzero(ids == START_ID), np.flatnonzero(ids == END_ID)
    for k, (s, e) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
        body = codec.decode(ids[s + 1 : e])
        role, _, text = body.partition("\n")
        turns.append((unescape_role(role), unescape(text)))
        own = ids[s + 1 : e][mask[s + 1 : e] == 1]
        if len(own):
            learned.append(unescape(codec.decode(own)))
        after = ids[e + 1 : starts[k + 1] if k + 1 < len(starts) else len(ids)]
        shown += [START, body, END, codec.decode(after)]
    return turns, learned, "".join(shown)


def digests(formatted: DataFrame, tokenizer: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Read back from the output of :func:`format`: counts and SHA-256 of the turns and of the trained text."""
    out = T.StructType([formatted.schema.fields[0], *T._parse_datatype_string("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_ids long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(tokenizer)
        for batch in batches:
            rows = []
            for ids, mask in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                turns, learned, shown = parse(np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.uint8), codec)
                whole, loss = "".join(f"{r}\n{t}\n" for r, t in turns), "".join(learned)
                rows.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(shown), len(ids) // 4))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds))], names=out.names)

    return formatted.mapInArrow(run, out)

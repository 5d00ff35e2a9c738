"""Chat formatting at the level of tokens.

Method. Every turn's role and text are encoded as segments of their own, with
control strings inside them escaped, and the reserved ids of the template are
spliced between the segments; no text can yield a reserved id. Over a
conversation's ids a +1 stands at each start of trained text and a -1 behind
its end, and the loss mask is their prefix sum. Token positions are prefix
sums of segment lengths.

Escaping is reversible: ``<``, k backslashes and ``|`` become ``<``, k + 1
backslashes and ``|`` (so ``<|`` never occurs in formatted content), and in
roles a line feed becomes backslash n and a backslash two backslashes.

Scale. Encoding is a map before the only shuffle, so a long conversation's
encoding is spread over tasks. Then rows are dealt by conversation and sorted
by turn, and stream through Arrow batches: the state kept is a position and a
mask level, never a whole conversation. The output is one row per turn.
Reading back streams in the same order with running digests.

Defined results: null role or text is empty; turns of equal number are ordered
by role and text, repeated rows stay repeated turns; a null turn comes first;
rows of a null conversation id form one conversation; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail.llm.common import by_bytes, tokenizer_file
from qtrail.llm.wordmemo import load_tokenizer, segments

START, END = "<|im_start|>", "<|im_end|>"
GROUP_BYTES = 1 << 20
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class Template:
    """Reserved ids follow the vocabulary: start, then end."""

    path: str
    trained_role: str = "assistant"

    def reserved(self, tok) -> tuple[int, int]:
        n = tok.get_vocab_size(with_added_tokens=True)
        return n, n + 1


TURN = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("position", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("loss_mask", T.ArrayType(T.ByteType()))])


def _encoded(rows: DataFrame, template: Template, keys: list[T.StructField]) -> DataFrame:
    """Rows with ``role_ids`` and ``text_ids``, segments encoded apart."""
    schema = T.StructType([*keys, T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("role_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("text_ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(template.path)
        tok.encode_special_tokens = True  # their strings in a text are ordinary text

        def encode(texts: list[str]) -> list[list[int]]:
            out = []
            for lo, hi in by_bytes([len(t) + 1 for t in texts], GROUP_BYTES):
                parts = [(i, p) for i in range(lo, hi) for p in segments(texts[i], GROUP_BYTES)]
                got: list[list[int]] = [[] for _ in range(lo, hi)]
                for (i, _), e in zip(parts, tok.encode_batch_fast([p for _, p in parts], add_special_tokens=False)):
                    got[i - lo] += e.ids
                out += got
            return out

        for b in batches:
            role, text = (b.column(c).to_pylist() for c in ("role", "text"))
            ids = [encode([escape_role(r) + "\n" for r in role]), encode([escape(t) for t in text])]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(x, pa.list_(pa.int32())) for x in ids)],
                                             names=schema.names)

    return rows.mapInArrow(run, schema)


def format_conversations(turns: DataFrame, path: str | None = None, conversation: str = "conv_id",
                         turn: str = "turn", role: str = "role", text: str = "text",
                         trained_role: str = "assistant") -> DataFrame:
    """One row per turn: the conversation id, ``n`` (its place from 0),
    ``position`` of its first token, ``ids`` and ``loss_mask``."""
    template = Template(path or tokenizer_file("byte_bpe_50k.json"), trained_role)
    rows = turns.select(F.col(conversation).alias("conversation"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    encoded = _encoded(rows, template, [rows.schema["conversation"], rows.schema["turn"]])
    ordered = (encoded.repartition("conversation").sortWithinPartitions("conversation", "turn", "role", "text")
               .select("conversation", "role", "role_ids", "text_ids"))
    schema = T.StructType([T.StructField(conversation, rows.schema["conversation"].dataType), *TURN.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, end = template.reserved(load_tokenizer(template.path))
        current, n, position, level = object(), 0, 0, 0
        for b in batches:
            out = []
            for c, r, head, body in zip(*(col.to_pylist() for col in b.columns)):
                if c != current:
                    current, n, position, level = c, 0, 0, 0
                ids = np.array([start, *head, *body, end], np.int32)
                change = np.zeros(ids.size + 1, np.int64)
                if r == template.trained_role:
                    change[1 + len(head)] += 1
                    change[1 + len(head) + len(body)] -= 1
                mask = level + np.cumsum(change)
                level = int(mask[-1])
                out.append((c, n, position, ids, mask[:-1].astype(np.int8)))
                n, position = n + 1, position + ids.size
            cols = list(zip(*out)) if out else [[]] * 5
            kinds = [b.schema.field(0).type, pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int8())]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds)], names=schema.names)

    return ordered.mapInArrow(run, schema)


def _turn_parts(tok, ids: np.ndarray, mask: np.ndarray, reserved: tuple[int, int]) -> tuple[str, str, str, str]:
    """Formatted, role, text and trained text of one output row."""
    start, end = reserved
    if ids[0] != start or ids[-1] != end:
        raise ValueError("a turn must stand between the reserved ids")
    inner = tok.decode(ids[1:-1].tolist(), skip_special_tokens=False)
    role, _, body = inner.partition("\n")
    trained = tok.decode(ids[mask == 1].tolist(), skip_special_tokens=False)
    return START + inner + END, unescape_role(role), unescape(body), unescape(trained)


def read_back(formatted: DataFrame, path: str | None = None, conversation: str = "conv_id") -> DataFrame:
    """Per conversation, from its ids and mask alone: ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars`` and
    ``n_tokens``."""
    path = path or tokenizer_file("byte_bpe_50k.json")
    kind = formatted.schema[conversation]
    schema = T.StructType([kind, T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                           T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()),
                           T.StructField("formatted_chars", T.LongType()), T.StructField("n_tokens", T.LongType())])
    # One shuffle in all: the rows come sorted by conversation and place
    # already when they are read straight from ``format_conversations``.
    ordered = (formatted.repartition(conversation).sortWithinPartitions(conversation, "n")
               .select(conversation, "ids", "loss_mask"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load_tokenizer(path)
        reserved = Template(path).reserved(tok)
        state: list | None = None

        def row(s: list) -> tuple:
            return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5], s[6]

        def batch(rows: list[tuple], key: pa.DataType) -> pa.RecordBatch:
            kinds = [key, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            cols = list(zip(*rows)) if rows else [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols, kinds)], names=schema.names)

        key = None
        for b in batches:
            done, key = [], b.schema.field(0).type
            for c, ids, mask in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if state is None or c != state[0]:
                    if state is not None:
                        done.append(row(state))
                    state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                whole, role, text, trained = _turn_parts(
                    tok, ids.values.to_numpy(), mask.values.to_numpy(), reserved)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[3] += len(trained)
                state[4].update(trained.encode())
                state[5] += len(whole)
                state[6] += len(ids)
            yield batch(done, key)
        if state is not None:
            yield batch([row(state)], key)

    return ordered.mapInArrow(run, schema)

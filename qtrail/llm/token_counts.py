"""Token counts of whole texts.

Method: an Arrow function gets batches of texts and returns lengths only. It
takes the texts in groups balanced by bytes, splits long ones at safe
boundaries (``wordmemo.segments``), and encodes each distinct piece once.
There is no shuffle: work is one map over the scan, memory is a group of
about one megabyte of text and a bounded memo, a lost task is simply rerun.

Defined results: a null text counts as empty (0 bytes, 0 tokens); special
strings inside texts count as the library counts them by default; repeated
rows give repeated results; other columns are dropped unless kept by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qtrail.llm.common import by_bytes, slices, tokenizer_file
from qtrail.llm.wordmemo import WordMemo, load_tokenizer, segments, spaced_pieces, split_flags

BATCH_BYTES = 1 << 20


def spaced_counter(path: str) -> WordMemo:
    """Counts of pieces of a byte-level vocabulary."""
    tok = load_tokenizer(path)
    vocab = tok.get_vocab()
    starts = np.zeros(max(vocab.values()) + 1, bool)
    starts[[i for s, i in vocab.items() if s.startswith("Ġ")]] = True

    def direct(pieces: list[str]) -> list[int]:
        return [len(e) for e in tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def joined(words: list[str]) -> list[int] | None:
        ids = np.array(tok.encode(" " + " ".join(words), add_special_tokens=False).ids)
        cut = split_flags(ids, starts, len(words), first=True)
        return None if cut is None else np.diff(cut).tolist()

    return WordMemo(direct, joined, lambda a, b: a + b, lead=" ")


def count_batch(memo: WordMemo, texts: list[str]) -> list[int]:
    out = []
    for lo, hi in by_bytes([len(t) + 1 for t in texts], BATCH_BYTES):
        if hi - lo == 1 and len(texts[lo]) > BATCH_BYTES:
            total = 0
            for part in segments(texts[lo], BATCH_BYTES):
                total += sum(memo.values(spaced_pieces(part)))
            out.append(total)
            continue
        split = [spaced_pieces(t) for t in texts[lo:hi]]
        counts = memo.values([p for pieces in split for p in pieces])
        ends = list(accumulate(map(len, split)))
        out.extend(sum(counts[a:b]) for a, b in zip([0, *ends], ends))
    return out


def token_counts(docs: DataFrame, path: str | None = None, text: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_bytes`` (UTF-8) and ``n_tokens`` of every text."""
    path = path or tokenizer_file("byte_bpe_50k.json")
    fields = [docs.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = spaced_counter(path)
        for b in slices(batches):
            texts = b.column(len(keep)).fill_null("").to_pylist()
            sizes = pa.array([len(t.encode()) for t in texts], pa.int64())
            counts = pa.array(count_batch(memo, texts), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], sizes, counts],
                                             names=[*keep, "n_bytes", "n_tokens"])

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)

"""Token counts of whole texts.

Arrow batches are regrouped into batches of about equal bytes, texts are cut at safe
boundaries (``tokens.py``) and only lengths come back. Equal pieces of a worker's
batches are encoded once. A sentencepiece model looks across white space, so its texts
are encoded whole, again in batches balanced by bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.runtime import id_and_text, texts
from millrace.llm.tokens import _loaded, json_encoder

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
BATCH_BYTES = 1 << 20


def balanced(items: list[str], sizes: list[int], batch_bytes: int) -> Iterator[list[str]]:
    """Runs of ``items`` that reach ``batch_bytes`` with their last one."""
    start, held = 0, 0
    for k, size in enumerate(sizes):
        held += size
        if held >= batch_bytes:
            yield items[start : k + 1]
            start, held = k + 1, 0
    if start < len(items):
        yield items[start:]


def counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to token counts, one per worker process and file."""
    key = ("counts", path)
    if key in _loaded:
        return _loaded[key]
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        _loaded[key] = lambda batch: [len(ids) for ids in model.encode(batch, num_threads=1)]
        return _loaded[key]
    _loaded[key] = json_encoder(path, lengths_only=True).counts
    return _loaded[key]


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes`` (UTF-8), ``n_tokens, over_limit``.

    ``tokenizer`` is the path of a ``tokenizers`` (.json) or sentencepiece (.model) file.
    A null text counts as empty; repeated rows and null ids come back as they are; an
    empty table gives no rows. Nothing is truncated.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = counter(tokenizer)
        for batch in batches:
            whole = texts(batch.column(1))
            sizes = [len(t) if t.isascii() else len(t.encode()) for t in whole]
            counts = [n for part in balanced(whole, sizes, batch_bytes) for n in tokens_of(part)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(count, SCHEMA)

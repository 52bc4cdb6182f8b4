"""Token counts of sections, from one encoding of the whole document.

A document is encoded once; its tokens' byte spans are joined with the sections' spans by binary search, both being
sorted. A token that crosses a boundary is allotted by `rule`: "first" gives it to the section that holds its first
byte, "most" to the section that holds most of its bytes, the earlier one on a tie.

Results for special cases: a null or empty text is one empty section with no tokens; repeated rows and null ids are kept,
each with its own rows; an empty table gives an empty result; other columns are not read. The counts of a
document's sections add up to the tokens of the whole document, since the sections tile it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import pretokens


def line_sections(text: str) -> list[int]:
    """Where each line starts, as code points; a line keeps its line feed."""
    starts, at = [0], text.find("\n")
    while 0 <= at < len(text) - 1:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return starts


def allot(token_ends: np.ndarray, section_starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token and whether it crosses a boundary; all offsets in bytes, tokens and sections tile the text."""
    token_starts = np.concatenate([[0], token_ends]).astype(np.int64)[: len(token_ends)]
    first = np.searchsorted(section_starts, token_starts, side="right") - 1
    last = np.searchsorted(section_starts, token_ends - 1, side="right") - 1
    section = first.copy()
    if rule == "most":
        limits = np.append(section_starts, token_ends[-1] if len(token_ends) else 0)
        for i in np.flatnonzero(first != last):
            own = np.arange(first[i], last[i] + 1)
            section[i] = own[np.argmax(np.minimum(limits[own + 1], token_ends[i]) - np.maximum(limits[own], token_starts[i]))]
    elif rule != "first":
        raise ValueError(f"unknown rule {rule!r}")
    return section, first != last


def _count(batches: Iterator[pa.RecordBatch], ranks: str, rule: str, sections: Callable[[str], list[int]]) -> Iterator[pa.RecordBatch]:
    encoder, lengths = pretokens.WordEncoder(ranks), pretokens.token_lengths(ranks)
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            texts = [t or "" for t in part.column(1).to_pylist()]
            source, out = [], [[] for _ in range(6)]
            for i, (text, ids) in enumerate(zip(texts, encoder.encode(texts), strict=True)):
                starts = np.array(sections(text), np.int64)
                if text.isascii():
                    at_bytes = starts
                else:
                    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                    width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
                    at_bytes = np.concatenate([[0], np.cumsum(width)])[starts]
                section, crossing = allot(np.cumsum(lengths[ids]), at_bytes, rule)
                n = len(starts)
                source += [i] * n
                ends = np.append(starts[1:], len(text))
                for column, values in zip(out, (np.arange(n), starts, ends, np.bincount(section, minlength=n), np.bincount(section[crossing], minlength=n), np.full(n, len(ids))), strict=True):
                    column.append(values)
            columns = [pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64()) for x in out]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(source, pa.int64())), *columns], ["id", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"])


def section_tokens(docs: DataFrame, ranks: str, rule: str = "first", sections: Callable[[str], list[int]] = line_sections, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each section of each document: section, start and end (code points), n_tokens, n_crossing, doc_tokens.

    `sections` gives the ascending starts of sections that tile a text, the first of them 0.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, section long, start long, end long, n_tokens long, n_crossing long, doc_tokens long"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(partial(_count, ranks=ranks, rule=rule, sections=sections), schema).withColumnRenamed("id", id_col)

"""Token counts of sections: whole documents are encoded once, and tokens are given to sections by their spans.

Encoding sections one by one would change tokens at their boundaries.  Here each token of the whole text has a byte span;
an interval join of the ordered spans and the ordered sections finds the sections that a token touches, and one explicit
rule gives a token that crosses a boundary to one of them:

- ``start``: the section of its first byte,
- ``end``: the section of its last byte,
- ``most``: the section with most of its bytes, the earlier one if equal.

So the counts of a document's sections add up to the tokens of the document under every rule.

The tokenizer's pattern engine gives up on white space of about a million characters in a row.  Such a run is cut out first: a
match holds white space at its front only, so the pattern must break where the run begins, and the run up to its last
character (all of it at the end of the text) is one word, which is merged here.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.llm import words as w
from courtlake.llm.byte_bpe import merge_long, read_ranks
from courtlake.llm.common import numbered

RULES = ("start", "end", "most")


#: White space of Unicode, and the characters of a run that is cut out.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 100_000


def encoder(path: str, pattern: str):
    """A tiktoken encoding from a file of ranks, the byte length of every id, and the ranks."""
    import tiktoken

    ranks = read_ranks(path)
    lengths = np.zeros(len(ranks), np.int64)
    for token, k in ranks.items():
        lengths[k] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths, ranks


def encode_whole(encode, ranks: dict[bytes, int], text: str, longest: int = LONG_RUN) -> np.ndarray:
    """Ids of a text; runs of white space of `longest` characters and more don't reach the pattern engine."""
    parts, at = [], 0
    for run in re.finditer(f"[{SPACE}]{{{longest},}}", text) if len(text) >= longest else ():
        end = run.end() - (run.end() < len(text))
        parts += [encode.encode_to_numpy(text[at:run.start()], disallowed_special=()), merge_long(text[run.start():end].encode(), ranks)]
        at = end
    parts.append(encode.encode_to_numpy(text[at:], disallowed_special=()))
    return np.concatenate([np.asarray(p, np.int64) for p in parts])


def attribute(token_starts: np.ndarray, token_ends: np.ndarray, cuts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary; `cuts` are the sections' first bytes, ascending from 0."""
    first = np.searchsorted(cuts, token_starts, side="right") - 1
    last = np.searchsorted(cuts, token_ends - 1, side="right") - 1
    crossing = first != last
    if rule == "start":
        return first, crossing
    if rule == "end":
        return last, crossing
    own = first.copy()
    for i in np.flatnonzero(crossing):
        edges = np.clip(np.append(cuts[first[i]:last[i] + 1], token_ends[i]), token_starts[i], token_ends[i])
        own[i] = first[i] + int(np.argmax(np.diff(edges)))
    return own, crossing


def _count(batches: Iterator[pa.RecordBatch], path: str, pattern: str, rule: str) -> Iterator[pa.RecordBatch]:
    encode, lengths, ranks = encoder(path, pattern)
    names = ["doc_id", "section", "start_char", "n_chars", "n_tokens", "n_crossing"]
    for batch in batches:
        ids = batch.column(0)
        texts = batch.column(1)
        for begin, end, data, offsets in w.chunks(texts):
            parts = []
            for i in range(end - begin):
                raw = data[offsets[i]:offsets[i + 1]]
                tokens = encode_whole(encode, ranks, texts[begin + i].as_py() or "")
                stops = np.cumsum(lengths[tokens])
                cuts = np.append(0, np.flatnonzero(raw[:-1] == 10) + 1) if len(raw) else np.zeros(1, np.int64)
                own, crossing = attribute(stops - lengths[tokens], stops, cuts, rule)
                chars = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
                starts = chars[cuts]
                parts.append((np.full(len(cuts), i), np.arange(len(cuts)), starts, np.diff(np.append(starts, chars[-1])), np.bincount(own, minlength=len(cuts)), np.bincount(own[crossing], minlength=len(cuts))))
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays([ids.slice(begin, end - begin).take(pa.array(columns[0])), pa.array(columns[1].astype(np.int32)), *(pa.array(c.astype(np.int64)) for c in columns[2:])], names)


def section_tokens(documents: DataFrame, tokenizer_path: str, pattern: str, rule: str = "start", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line of every document: doc_id, section (from 0), start_char, n_chars, n_tokens, n_crossing.

    A section is a line with the newline that ends it; together the sections are the whole text.  n_crossing counts those
    of its tokens that reach into another section.  A null or empty text is one empty section without tokens.  Rows that
    repeat an id are counted one by one; null ids are kept; an empty table gives no rows; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    schema = "doc_id long, section int, start_char long, n_chars long, n_tokens long, n_crossing long"
    return numbered(documents, id_col, text_col).mapInArrow(lambda it: _count(it, tokenizer_path, pattern, rule), schema)


def document_tokens(sections: DataFrame) -> DataFrame:
    """Totals by document of section_tokens()."""
    return sections.groupBy("doc_id").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_sections"))

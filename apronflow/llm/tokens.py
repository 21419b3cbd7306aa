"""Encoding with a public byte-level BPE tokenizer.

A long text is cut into chunks that overlap. Pre-tokenisation of a chunk begins at an arbitrary
place, so its first boundaries may be wrong, but it falls into step: once a boundary is shared with
the pre-tokenisation of the chunk before, all later ones are. In the overlap both are computed and
the text is cut at such a boundary; the pieces are then encoded on their own and their ids joined.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession

#: Characters of a chunk, and of the overlap of two.
CHUNK, OVERLAP = 16_384, 512
#: Where the vocabulary files are; a session may name another folder.
FOLDER, FOLDER_KEY = "/opt/tokenizers", "apronflow.tokenizers"
#: Fixed value: the pre-tokenisation pattern of the public 50k byte-level vocabulary, in its equivalent possessive form.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Characters at a chunk's end whose boundaries the text beyond could still move (a contraction has three).
UNSURE = 4


def folder(spark: SparkSession) -> str:
    return spark.conf.get(FOLDER_KEY, FOLDER)


@functools.lru_cache(maxsize=4)
def encoding(path: str) -> tiktoken.Encoding:
    """One tokenizer per worker process and file."""
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in Path(path).read_bytes().splitlines() if line)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id."""
    e = encoding(path)
    return [e.decode_single_token_bytes(i) for i in range(e.n_vocab)]


_pretokens = regex.compile(PATTERN)


def boundaries(text: str) -> list[int]:
    """Where pre-tokens begin."""
    return [m.start() for m in _pretokens.finditer(text)]


#: Characters whose class no edition of Unicode has changed, so that every regular-expression engine agrees on it.
LETTERS = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0391-\u03a1\u03a3-\u03c9\u0400-\u0481\u048a-\u0513\u05d0-\u05ea\u0621-\u063a\u0641-\u064a\u0905-\u0939\u0e01-\u0e30\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
DIGITS = r"0-9\uff10-\uff19"
MARKS = r"!-&(-/:-@\[-`{-~\u0901-\u0903\u093e-\u094d\u0e31\u0e34-\u0e3a\u0e47-\u0e4e\u2010-\u2027\u3001-\u3003\u3008-\u3011\uff01-\uff0f\uff1a-\uff20"
BLANKS = r" \t\r\n\u3000"
#: Changes of character class that no pre-token reaches over, whatever stands before or after them. Only an apostrophe may take letters along.
_falls = regex.compile(rf"(?<=[{LETTERS}])[{DIGITS}{MARKS}{BLANKS}']|(?<=[{DIGITS}])[{LETTERS}{MARKS}{BLANKS}']|(?<=[{MARKS}'])[{DIGITS}{BLANKS}]|(?<=[{MARKS}])[{LETTERS}]")
#: Chunks of one text that are encoded at a time.
THREADS = 4


def cuts(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Places at which a text may be cut without changing its ids.

    About each multiple of chunk, the overlap of the two chunks there is pre-tokenised twice, from its
    beginning and from its middle. Both runs may begin out of step. Each is in step from its first
    fall on (a change of character class that always ends a pre-token), and the cut is the first
    boundary at a fall that both have. Where the overlap holds none it doubles; a text without any
    (one run of letters, say) stays whole.
    """
    out: list[int] = []
    for nominal in range(chunk, len(text), chunk):
        reach = overlap
        while reach <= 2 * chunk:
            lo, hi = max(0, nominal - reach // 2), min(len(text), nominal + reach // 2)
            left = {b + lo for b in boundaries(text[lo:hi])}
            right = (b + nominal for b in boundaries(text[nominal:hi]))
            shared = (b for b in right if nominal < b < hi - UNSURE and b in left)
            cut = next((b for b in shared if _falls.match(text, b)), None)
            if cut is not None:
                out.append(cut)
                break
            reach *= 2
    return sorted(set(out))


def encode(texts: Sequence[str | None], path: str) -> list[list[int]]:
    """Ids of each text, without special tokens; null and empty texts have none. A special token's name is ordinary text.

    The chunks of a long text are pre-tokenised and encoded in parallel, so it is not bound to one core.
    """
    e, out = encoding(path), []
    for text in texts:
        if not text:
            out.append([])
        elif len(text) <= CHUNK:
            out.append(e.encode_ordinary(text))
        else:
            at = [0, *cuts(text), len(text)]
            chunks = [text[i:j] for i, j in zip(at, at[1:], strict=False)]
            # the tokenizer works outside the interpreter's lock, so chunks of one text go side by side where they outweigh the threads
            parts = e.encode_ordinary_batch(chunks, num_threads=THREADS) if len(chunks) >= 2 * THREADS else map(e.encode_ordinary, chunks)
            out.append(list(itertools.chain.from_iterable(parts)))
    return out


def decode(ids: Sequence[int], path: str) -> bytes:
    """The raw bytes of the ids, joined; of a whole text's ids they are its UTF-8."""
    table = token_bytes(path)
    return b"".join(table[i] for i in ids)


def lists(ids: list[list[int]]) -> pa.Array:
    """An Arrow list<int32> without a Python object per id in between."""
    size = np.fromiter((len(x) for x in ids), np.int64, len(ids))
    flat = np.concatenate([np.asarray(x, np.int32) for x in ids]) if len(ids) else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), pa.array(flat, pa.int32()))


def small_batches(batches: Iterator[pa.RecordBatch], column: str, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches of bounded text, so that memory follows neither the batch size nor the texts' lengths."""
    for b in batches:
        size = np.asarray(pc.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        group = np.cumsum(size) // chars
        at = np.r_[0, np.flatnonzero(np.diff(group)) + 1, b.num_rows]
        for i, j in zip(at, at[1:], strict=False):
            if j > i:
                yield b.slice(i, j - i)


def _encoder(path: str, key: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column(key), lists(encode(b.column("text").to_pylist(), path))], names=[key, "ids"])

    return work


def encoded(documents: DataFrame, key: str = "doc_id", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """key and ids (array of int) of each row of documents (key, text).

    Null and empty texts have an empty list, blank texts the ids of their blanks. Every row gives one
    row, repeated and null keys too. Extra columns are ignored. There is no shuffle: texts are encoded
    where they are read.
    """
    path = f"{folder(documents.sparkSession)}/{vocabulary}"
    kind = dict(documents.dtypes)[key]
    return documents.select(key, "text").mapInArrow(_encoder(path, key), f"`{key}` {kind}, ids array<int>")


def decoded(ids: DataFrame, key: str = "doc_id", vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """key and text of each row of ids (key, ids): the inverse of encoded, but that null texts come back empty."""
    path = f"{folder(ids.sparkSession)}/{vocabulary}"
    kind = dict(ids.dtypes)[key]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [decode(x or [], path).decode("utf-8", "replace") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(texts, pa.string())], names=[key, "text"])

    return ids.select(key, "ids").mapInArrow(work, f"`{key}` {kind}, text string")

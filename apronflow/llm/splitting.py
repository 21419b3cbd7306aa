"""Texts over a limit cut into pieces, at natural boundaries where there are any, with an overlap.

The text is encoded once. Line ends are the candidates, block ends (a blank line behind) the better
ones; where no line ends, the ends of sentences, then blanks, then changes between words and marks. Around every line end the words of the lines before and after are compared: the cosine of two
sliding blocks of hashed token counts is high within a topic and has a valley where the topic
changes. Of the candidates within reach of a piece the deepest valley is the cut; each piece begins
with the last tokens of the one before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from apronflow.llm import tokens


@dataclass(frozen=True)
class Split:
    limit: int = 512
    overlap: int = 64
    #: Lines of a sliding block, and dimensions that token ids are hashed to.
    lines: int = 6
    dims: int = 32
    #: A piece's new tokens fill at least this share of what they may, if a boundary allows it.
    fill: float = 0.5


def marks(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per id: ends a line, is nothing but blanks, and its number of bytes."""
    table = tokens.token_bytes(path)
    ends = np.fromiter((t.endswith((b"\n", b"\r")) for t in table), bool, len(table))
    blank = np.fromiter((not t.strip(b" \t\r\n\x0b\x0c") for t in table), bool, len(table))
    return ends, blank, np.fromiter(map(len, table), np.int64, len(table))


#: Bytes that are blanks, that end a sentence when a blank follows, and that belong to words; ends of sentences that need no blank.
BLANK_BYTES, STOP_BYTES = np.isin(np.arange(256), list(b" \t\r\n\x0b\x0c")), np.isin(np.arange(256), list(b".!?;"))
WORD_BYTES = np.isin(np.arange(256), [*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)])
WIDE_STOPS = tuple("。！？．".encode()[i : i + 3] for i in (0, 3, 6, 9))


def inner_cut(raw: np.ndarray, at: np.ndarray) -> int:
    """Where to cut a stretch without line ends: the last of the places (byte offsets) that is a sentence's end, else a blank, else an end of a word, else the last between characters.

    Gives the place's number.
    """
    before, behind = raw[at - 1], raw[at]
    whole = behind & 0xC0 != 0x80
    wide = np.zeros(len(at), bool)
    for k in np.flatnonzero(whole & (before >= 0x80) & (at >= 3)):
        wide[k] = raw[at[k] - 3 : at[k]].tobytes() in WIDE_STOPS
    sentence = (STOP_BYTES[before] & BLANK_BYTES[behind]) | wide
    blank = BLANK_BYTES[behind] | BLANK_BYTES[before]
    edge = ~(WORD_BYTES[before] & WORD_BYTES[behind])
    for good in (sentence, blank, edge):
        hit = np.flatnonzero(good & whole)
        if len(hit):
            return int(hit[-1])
    hit = np.flatnonzero(whole)
    return int(hit[-1]) if len(hit) else len(at) - 1


def valleys(ids: np.ndarray, line: np.ndarray, blank: np.ndarray, rule: Split) -> np.ndarray:
    """Depth of the cohesion valley behind each line: how far both neighbouring peaks rise over it.

    line: the line number of each token. Blank tokens say nothing about the topic.
    """
    count = int(line[-1]) + 1
    words = ~blank[ids]
    # Knuth's multiplicative hash spreads ids over the dimensions
    bin_ = (line[words] * rule.dims + ((ids[words].astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(16)) % rule.dims).astype(np.int64)
    grid = np.bincount(bin_, minlength=count * rule.dims).reshape(count, rule.dims)
    sums = np.zeros((count + 1, rule.dims), np.float32)
    np.cumsum(grid, 0, out=sums[1:])
    at = np.arange(1, count + 1)
    left = sums[at] - sums[np.maximum(at - rule.lines, 0)]
    right = sums[np.minimum(at + rule.lines, count)] - sums[at]
    size = np.sqrt((left**2).sum(1) * (right**2).sum(1))
    cosine = np.where(size > 0, (left * right).sum(1) / np.maximum(size, 1e-9), 0.0)
    peak_left, peak_right = cosine.copy(), cosine.copy()
    for k in range(1, 2 * rule.lines + 1):
        if k < count:
            peak_left[k:] = np.maximum(peak_left[k:], cosine[:-k])
            peak_right[:-k] = np.maximum(peak_right[:-k], cosine[k:])
    return peak_left + peak_right - 2 * cosine


def split(ids: np.ndarray, raw: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray], rule: Split) -> np.ndarray:
    """Where the pieces' new tokens begin: 0, the cuts, and the end. Piece k holds the tokens from overlap before its cut on.

    raw: the text's bytes, which the ids are of.
    """
    n = len(ids)
    if n <= rule.limit:
        return np.array([0, n])
    ends, blank, size = table
    offset = np.r_[0, np.cumsum(size[ids])]
    stop = ends[ids]
    last = np.flatnonzero(stop)
    line = np.r_[0, np.cumsum(stop)[:-1]]
    depth = valleys(ids, line, blank, rule) if len(last) else np.zeros(0)
    begins = np.r_[0, last + 1]
    begins = begins[begins < n]
    empty = np.logical_and.reduceat(blank[ids], begins)  # lines of nothing but blanks
    # a block ends where blank lines do, or at a line end before which a blank line stands at once ("\n\n" is one token)
    count = len(last)
    follows = np.r_[empty[1:], np.zeros(max(0, count - len(empty) + 1), bool)][:count]
    double = np.zeros(count, bool)
    inner = last > 0
    double[inner] = stop[last[inner] - 1] | (ids[last[inner]] == DOUBLE)
    block = (empty[:count] | double) & ~follows
    depth = depth[:count]
    where = last + 1
    cuts, at = [0], 0
    while True:
        # the first piece may be all new; the others repeat the overlap
        most = rule.limit if at == 0 else rule.limit - rule.overlap
        if n - at <= most:
            break
        low, high = at + max(1, int(most * rule.fill)), at + most
        # the first piece must hold the overlap that the next one repeats
        a, b, c = np.searchsorted(where, [at + 1 if at else rule.overlap, low, high + 1])
        best = -1
        for lo, hi, wanted in ((b, c, block), (b, c, None), (a, b, block), (a, b, None)):
            if lo < hi:
                score = depth[lo:hi] if wanted is None else np.where(wanted[lo:hi], depth[lo:hi], -1.0)
                k = int(len(score) - 1 - np.argmax(score[::-1]))  # of equal valleys the last
                if score[k] >= 0:
                    best = int(where[lo + k])
                    break
        if best < 0:  # no line ends here
            first = max(low, rule.overlap) if at == 0 else low
            best = first + inner_cut(raw, offset[first : high + 1])
        cuts.append(best)
        at = best
    return np.array([*cuts, n])


#: Fixed value: the id of two line feeds in the 50k vocabulary.
DOUBLE = 628


def _splitter(path: str, key: str, rule: Split):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = marks(path)
        for b in tokens.small_batches(batches, "text", 2_000_000):
            row, piece, first, size, ids_out, text_out = [], [], [], [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                if not text:
                    continue
                ids = np.asarray(tokens.encode([text], path)[0], np.int32)
                if len(ids) <= rule.limit:
                    row.append(i), piece.append(0), first.append(0), size.append(len(ids)), ids_out.append(ids), text_out.append(text)
                    continue
                encoded = text.encode()
                raw = np.frombuffer(encoded, np.uint8)
                at = split(ids, raw, table, rule)
                offset = np.r_[0, np.cumsum(table[2][ids])]
                begin = np.maximum(at[:-1] - rule.overlap, 0)
                begin[0] = 0
                for k, (x, y) in enumerate(zip(begin.tolist(), at[1:].tolist(), strict=True)):
                    p = int(offset[x])
                    while raw[p] & 0xC0 == 0x80:  # an overlap that begins within a character: its text begins with the next one
                        p += 1
                    row.append(i), piece.append(k), first.append(x), size.append(y - x), ids_out.append(ids[x:y])
                    text_out.append(encoded[p : offset[y]].decode())
            if row:
                yield pa.RecordBatch.from_arrays(
                    [b.column(key).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(first, pa.int32()), pa.array(size, pa.int32()), tokens.lists(ids_out), pa.array(text_out, pa.string())],
                    names=[key, "piece", "first_token", "tokens", "ids", "text"],
                )

    return work


def pieces(documents: DataFrame, key: str = "doc_id", rule: Split = Split(), vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """The pieces of each document in order: key, piece, first_token, tokens, ids, text.

    A text of at most limit tokens is one piece. Longer ones are cut behind line ends: among those
    that fill at least half of what a piece may newly take, behind block ends if there are any; else
    behind earlier ones. Where no line ends within reach the cut is behind a sentence, else at a blank,
    else where a word ends, else between two characters at the limit. Every piece but the first repeats the last `overlap`
    tokens of the one before, and has at most limit tokens with them. Dropping the overlap and joining
    ids gives the document's ids. text is the slice of the document that ids are of; where the overlap
    begins within a character of several tokens, text begins with the next character.
    Null and empty texts have no pieces; repeated rows have theirs each; extra columns are ignored.

    Scale: one document's pieces depend on that document alone, so there is no shuffle.
    """
    path = f"{tokens.folder(documents.sparkSession)}/{vocabulary}"
    kind = dict(documents.dtypes)[key]
    return documents.select(key, "text").mapInArrow(_splitter(path, key, rule), f"`{key}` {kind}, piece int, first_token int, tokens int, ids array<int>, text string")

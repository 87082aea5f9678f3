"""Byte-level BPE over whole corpora, without regular expressions in the hot path.

A batch of texts becomes one array of code points, then one of character classes. Each position's class stands for a function
from the tokenizer's state to its next state and to a cut before that position. These functions compose associatively: the
array is laid out in blocks, all blocks are composed at once for every possible entry state, the block functions are chained,
and every block is then replayed from its true entry state. Slices between cuts feed a merge cache.
"""

from __future__ import annotations

import base64
import sys
import unicodedata
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"

# Character classes. The last three are an apostrophe that would start a contraction of two or three characters.
LETTER, NUMBER, OTHER, SPACE, LAST_SPACE, BLANK, LAST_BLANK, START, MARK2, MARK3 = range(10)
# States: which kind of token is open, or how much of a contraction is still to be read.
NONE, IN_LETTER, IN_NUMBER, IN_OTHER, IN_BLANK, AFTER_SPACE, REST1, REST2 = range(8)
N_STATE, N_CLASS = 8, 10


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, cut before) by class and state.

    The rules of the pattern: a contraction or a run of letters, numbers or other visible characters, each run with at most one
    space before it; a run of white space stops before its last character if something visible follows.
    """
    step = np.zeros((N_CLASS, N_STATE), np.uint8)
    cut = np.ones((N_CLASS, N_STATE), bool)
    for state in range(N_STATE):
        for kind, run in ((LETTER, IN_LETTER), (NUMBER, IN_NUMBER), (OTHER, IN_OTHER)):
            step[kind, state] = run
            cut[kind, state] = state not in (run, AFTER_SPACE)
        if state in (REST1, REST2):  # the letters of a contraction belong to it
            step[LETTER, state] = NONE if state == REST1 else REST1
            cut[LETTER, state] = False
        for kind, rest in ((MARK2, REST1), (MARK3, REST2)):
            inside = state in (IN_OTHER, AFTER_SPACE)
            step[kind, state] = IN_OTHER if inside else rest
            cut[kind, state] = not inside
        for kind in (SPACE, BLANK):
            step[kind, state] = IN_BLANK
            cut[kind, state] = state != IN_BLANK
        step[LAST_SPACE, state], step[LAST_BLANK, state] = AFTER_SPACE, NONE
        step[START, state] = NONE
    return step, cut


STEP, CUT = _machine()


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point: letters, numbers, white space, the rest."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))[0]
        out[c] = LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
    spaces = [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    out[spaces] = BLANK
    out[0x20] = SPACE
    return out


def _scan(classes: np.ndarray, width: int = 512) -> np.ndarray:
    """Cuts before each position, by block-wise composition of the transition functions."""
    n = len(classes)
    blocks = -(-n // width)
    grid = np.full(blocks * width, START, np.uint8)
    grid[:n] = classes
    grid = grid.reshape(blocks, width).T.copy()  # one row per place in a block
    reach = np.broadcast_to(np.arange(N_STATE, dtype=np.uint8), (blocks, N_STATE)).copy()
    flat = STEP.reshape(-1)
    for row in grid:
        reach = flat[row[:, None].astype(np.int16) * N_STATE + reach]
    entry, state = np.empty(blocks, np.uint8), NONE
    for b in range(blocks):
        entry[b], state = state, reach[b, state]
    cuts, flat_cut = np.empty((width, blocks), bool), CUT.reshape(-1)
    for i, row in enumerate(grid):
        at = row.astype(np.int16) * N_STATE + entry
        cuts[i] = flat_cut[at]
        entry = flat[at]
    return cuts.T.reshape(-1)[:n]


def boundaries(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions where tokens begin in the joined code points of texts that begin at ``starts`` (non-empty texts only)."""
    kind = _classes()[codes]
    first = np.zeros(len(codes) + 1, bool)
    first[starts] = True
    first[-1] = True
    white = (kind == SPACE) | (kind == BLANK)
    ends = first[1:]  # nothing of the same text follows
    follows = np.zeros(len(codes), bool)
    follows[:-1] = ~white[1:]
    last = white & follows & ~ends
    kind = kind.copy()
    kind[last & (kind == SPACE)] = LAST_SPACE
    kind[last & (kind == BLANK)] = LAST_BLANK
    marks = np.flatnonzero(codes == 0x27)
    if len(marks):
        pad = np.concatenate([codes, np.zeros(2, codes.dtype)])
        ended = np.concatenate([ends, np.ones(2, bool)])
        one, two = pad[marks + 1], pad[marks + 2]
        has1 = ~ended[marks]
        has2 = has1 & ~ended[marks + 1]
        short = has1 & np.isin(one, [ord(c) for c in "stmd"])
        pair = one.astype(np.int64) << 32 | two
        long = has2 & np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])
        kind[marks[short]] = MARK2
        kind[marks[long]] = MARK3
    # every text is its own sequence: a START class stands before it
    text_no = np.cumsum(first[:-1]) - 1
    at = np.arange(len(codes)) + text_no + 1
    seq = np.full(len(codes) + len(starts), START, np.uint8)
    seq[at] = kind
    return np.flatnonzero(_scan(seq)[at] | first[:-1])


class Encoder:
    """Byte pair merging by ranks with a cache of slices."""

    def __init__(self, ranks_path: str, cache: int = 1_000_000) -> None:
        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.cache: dict[str, tuple[int, ...]] = {}
        self.most = cache

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one slice: the pair of lowest rank is joined until no pair has a rank; long slices use a heap."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(piece) > 64:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        import heapq

        ranks, n = self.ranks, len(piece)
        end = [i + 1 for i in range(n)]  # end of the part that begins at i, 0 if none does
        prev = [i - 1 for i in range(n)]
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, j = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= n or end[middle] != j:
                continue
            end[i], end[middle] = j, 0
            if j < n:
                prev[j] = i
                if (r := ranks.get(piece[i : end[j]])) is not None:
                    heapq.heappush(heap, (r, i, end[j]))
            if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:j])) is not None:
                heapq.heappush(heap, (r, p, j))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts joined, first id of each text plus the end, character offset in its text of each id's slice)."""
        full = [t for t in texts if t]
        bounds = np.zeros(len(texts) + 1, np.int64)
        if not full:
            return np.empty(0, np.int32), bounds, np.empty(0, np.int32)
        joined = "".join(full)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.array([len(t) for t in full])
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        begin = boundaries(codes, starts)
        cache, merge = self.cache, self.merge
        if len(cache) > self.most:
            cache.clear()
        ids, count = [], np.empty(len(begin), np.int32)
        at = begin.tolist()
        for k, (i, j) in enumerate(zip(at, [*at[1:], len(joined)], strict=True)):
            piece = joined[i:j]
            got = cache.get(piece)
            if got is None:
                got = merge(piece.encode("utf-8", "replace"))
                if j - i <= 64:
                    cache[piece] = got
            ids += got
            count[k] = len(got)
        first_piece = np.searchsorted(begin, starts)
        total = np.concatenate([[0], np.cumsum(count)])
        per = np.diff(np.concatenate([total[first_piece], [total[-1]]]))
        sizes = np.zeros(len(texts), np.int64)
        sizes[[i for i, t in enumerate(texts) if t]] = per
        bounds[1:] = np.cumsum(sizes)
        offsets = np.repeat(begin - np.repeat(starts, np.diff(np.concatenate([first_piece, [len(begin)]]))), count)
        return np.array(ids, np.int32), bounds, offsets.astype(np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of ids."""
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")


@lru_cache(4)
def encoder(ranks_path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(ranks_path)


def encode(df: DataFrame, key: str, text: str, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS, offsets: bool = False) -> DataFrame:
    """(key, ids[, offsets]) for every row: the token ids of ``text`` without special tokens.

    tokenizer: a byte-level vocabulary with a ``.tiktoken`` file in ``folder``. offsets: also the place, in characters, of the
    slice from which each id comes, for decoding parts of a text. A null and an empty text give an empty list; strings that
    look like special tokens are ordinary text; lone surrogates, which Spark strings cannot hold, do not occur. Repeated
    rows give repeated results; further columns of any name are ignored. Texts of any length are encoded whole.
    """

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        coder = encoder(f"{folder}/{tokenizer}.tiktoken")
        for given in batches:
            for lot in _lots(given):
                ids, bounds, places = coder.encode_batch(lot.column(1).to_pylist())
                lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(x, pa.int32())) for x in ((ids, places) if offsets else (ids,))]
                yield pa.RecordBatch.from_arrays([lot.column(0), *lists], names=["_key", "_ids", "_offsets"][: 1 + len(lists)])

    kind = dict(df.dtypes)[key]
    out = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, f"_key {kind}, _ids array<int>" + ", _offsets array<int>" * offsets)
    return out.toDF(*[key, "ids", "offsets"][: 2 + offsets])


def _lots(batch, size: int = 8_000_000):  # noqa: ANN001, ANN202
    """Slices of a batch with about ``size`` bytes of text each, so that memory does not follow the length of the texts."""
    import pyarrow.compute as pc

    sums = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        base = sums[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sums, base + size, "right")))
        yield batch.slice(at, to - at)
        at = to


def token_counts(df: DataFrame, key: str, text: str, tokenizers: list[str], folder: str = TOKENIZERS) -> DataFrame:
    """(key, tokenizer, tokens) for every row and tokenizer: byte-level ones by ``encode``, the others by their libraries."""

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            for lot in _lots(given):
                texts = [t or "" for t in lot.column(1).to_pylist()]
                for name in tokenizers:
                    yield pa.RecordBatch.from_arrays([lot.column(0), pa.array([name] * len(texts)), pa.array(count_tokens(texts, name, folder), pa.int32())], names=["_key", "tokenizer", "tokens"])

    kind = dict(df.dtypes)[key]
    out = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, f"_key {kind}, tokenizer string, tokens int")
    return out.toDF(key, "tokenizer", "tokens")


def count_tokens(texts: list[str], name: str, folder: str) -> np.ndarray:
    """Token counts of texts by any public tokenizer, without special tokens."""
    import os

    if os.path.exists(f"{folder}/{name}.tiktoken"):
        return np.diff(encoder(f"{folder}/{name}.tiktoken").encode_batch(texts)[1])
    model = _library(f"{folder}/{name}")
    return np.array([len(x) for x in model(texts)], np.int64)


@lru_cache(4)
def _library(stem: str):  # noqa: ANN202
    import os

    if os.path.exists(f"{stem}.model"):
        import sentencepiece

        piece = sentencepiece.SentencePieceProcessor(model_file=f"{stem}.model")
        return lambda texts: piece.encode(texts, num_threads=1)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(f"{stem}.json")
    whole.encode_special_tokens = True
    return lambda texts: [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]

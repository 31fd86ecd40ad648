"""SentencePiece encoding by suffix-array matching, and decoding.

The distinct pre-tokens of a batch are concatenated and indexed by a suffix
array.  Every piece is binary-searched for its range of occurrences; the
ranges become lattice edges, which are sorted by where they end and relaxed
in that order, all pre-tokens side by side.  Walking back from the ends gives
the pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldbook.llm.common import lean, quoted
from fieldbook.llm.vocab import DEFAULT_MODEL, Vocab, load_vocab, pretokens

BLOCK_BYTES = 4 << 20  # text bytes that share one dictionary of pre-tokens
INDEX_BYTES = 1 << 18  # concatenated pre-tokens per suffix array
SIDE_BY_SIDE = 64  # longer pre-tokens are relaxed one edge at a time
_END = 0xFF  # ends a pre-token; never a byte of UTF-8


def _pack8(data: np.ndarray, n: int) -> np.ndarray:
    """Big-endian uint64 of the 8 bytes from each of the first n positions."""
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = (key << np.uint64(8)) | data[j:j + n].astype(np.uint64)
    return key


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions in suffix order by their first ``depth`` bytes, packed first 8 bytes by position).

    Prefix doubling from 8 bytes: ranks of halves are the next round's keys.
    """
    n = len(data)
    key8 = _pack8(np.concatenate([data, np.full(8, _END, np.uint8)]), n)
    key, width = key8, 8
    while True:
        order = np.argsort(key)
        if width >= depth:
            return order, key8
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])]).astype(np.uint64)
        tail = np.full(n, n, np.uint64)
        tail[:max(0, n - width)] = rank[width:]
        key, width = (rank << np.uint64(32)) | tail, width * 2


class PieceIndex:
    """The pieces as packed 8-byte levels, ready for the binary searches."""

    def __init__(self, vocab: Vocab):
        names = sorted(vocab.ids)
        self.ids = np.array([vocab.ids[p] for p in names], np.int64)
        self.score = np.array([vocab.scores[p] for p in names])
        self.size = np.array([len(p) for p in names], np.int64)
        self.one_char = np.array([len(p.decode("utf-8")) == 1 for p in names])
        self.depth = int(self.size.max())
        levels = -(-self.depth // 8)
        low = np.zeros((len(names), levels * 8), np.uint8)
        high = np.full((len(names), levels * 8), 0xFF, np.uint8)
        for i, p in enumerate(names):
            low[i, :len(p)] = high[i, :len(p)] = np.frombuffer(p, np.uint8)
        self.low = low.reshape(len(names), levels, 8).astype(np.uint64)
        self.high = high.reshape(len(names), levels, 8).astype(np.uint64)
        shifts = np.uint64(8) * np.arange(7, -1, -1, dtype=np.uint64)
        self.low = (self.low << shifts).sum(axis=2, dtype=np.uint64)
        self.high = (self.high << shifts).sum(axis=2, dtype=np.uint64)
        self.byte_ids = np.array(vocab.byte_ids, np.int64)
        self.byte_score = vocab.byte_score

    def ranges(self, order: np.ndarray, key8: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of every piece in suffix order."""
        n = len(order)
        far = np.concatenate([key8, np.full(self.depth + 8, np.iinfo(np.uint64).max, np.uint64)])
        lo, hi = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), n, np.int64)
        for level in range(self.low.shape[1]):
            at = np.flatnonzero((self.size > 8 * level) & (lo < hi))
            if not len(at):
                break
            bounds = []
            for target, right in ((self.low[at, level], False), (self.high[at, level], True)):
                a, b = lo[at].copy(), hi[at].copy()
                while (open_ := a < b).any():
                    mid = (a + b) >> 1
                    here = far[order[np.minimum(mid, n - 1)] + 8 * level]
                    go = open_ & ((here <= target) if right else (here < target))
                    a, b = np.where(go, mid + 1, a), np.where(open_ & ~go, mid, b)
                bounds.append(a)
            lo[at], hi[at] = bounds
        return lo, np.maximum(lo, hi)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... counts[0] of them, then the next."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def encode_words(words: list[bytes], index: PieceIndex) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after another, number of ids of each word)."""
    data = np.frombuffer(b"\xff".join(words) + b"\xff", np.uint8)
    n = len(data)
    stops = np.flatnonzero(data == _END)
    starts = np.concatenate([[0], stops[:-1] + 1])
    start_of = np.repeat(starts, stops - starts + 1)
    order, key8 = suffix_array(data, index.depth)
    lo, hi = index.ranges(order, key8)
    counts = hi - lo
    pos = order[_spread(lo, counts)]
    piece = np.repeat(np.arange(len(counts)), counts)
    # characters without a piece: one edge over all their bytes
    spelt = ((data & 0xC0) != 0x80) & (data != _END)
    spelt[pos[index.one_char[piece]]] = False
    odd = np.flatnonzero(spelt)
    width = 1 + (data[odd] >= 0xC0).astype(np.int64) + (data[odd] >= 0xE0) + (data[odd] >= 0xF0)
    pos = np.concatenate([pos, odd])
    size = np.concatenate([index.size[piece], width])
    gain = np.concatenate([index.score[piece], width * index.byte_score])
    piece = np.concatenate([piece, np.full(len(odd), -1)])
    best = np.full(n + 1, -np.inf)
    best[starts] = 0.0
    back = np.zeros(n + 1, np.int64)  # size of the last piece
    last = np.zeros(n + 1, np.int64)  # the piece, or -1
    end = pos + size - start_of[pos]
    long = np.repeat(stops - starts > SIDE_BY_SIDE, stops - starts + 1)[pos]
    near = np.flatnonzero(~long)
    near = near[np.argsort((end[near] * 64 + size[near]).astype(np.uint16), kind="stable")]
    if len(near):
        rank = end[near] * 64 + size[near]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        p, s, g, k = pos[near], size[near], gain[near], piece[near]
        for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(near)]])):
            # one end and one length: every pre-token has one such edge at most
            to, offer = p[a:b] + s[a], best[p[a:b]] + g[a:b]
            better = offer > best[to]
            to = to[better]
            best[to], back[to], last[to] = offer[better], s[a], k[a:b][better]
    far = np.flatnonzero(long)
    far = far[np.lexsort((size[far], pos[far] + size[far]))]
    for p, s, g, k in zip(pos[far].tolist(), size[far].tolist(), gain[far].tolist(), piece[far].tolist()):
        offer = best[p] + g
        if offer > best[p + s]:
            best[p + s], back[p + s], last[p + s] = offer, s, k
    token = np.full(n, -1, np.int64)
    at = stops.copy()
    begin = starts
    while len(at):
        size_here, piece_here = back[at], last[at]
        prev = at - size_here
        known = piece_here >= 0
        token[prev[known]] = index.ids[piece_here[known]]
        spans = _spread(prev[~known], size_here[~known])
        token[spans] = index.byte_ids[data[spans]]
        more = prev > begin
        at, begin = prev[more], begin[more]
    on = token >= 0
    total = np.concatenate([[0], np.cumsum(on)])
    return token[on], total[stops] - total[starts]


def encode_texts(texts: list[bytes | None], index: PieceIndex) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, number of ids of each text)."""
    known: dict[bytes, int] = {}
    uses = []
    for t in texts:
        words = pretokens(t) if t else []
        uses.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
    flat, per_word, part, size = [], [], [], 0
    for w in known:
        part.append(w)
        size += len(w) + 1
        if size > INDEX_BYTES:
            f, c = encode_words(part, index)
            flat.append(f), per_word.append(c)
            part, size = [], 0
    if part:
        f, c = encode_words(part, index)
        flat.append(f), per_word.append(c)
    if not flat:
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    ids, n = np.concatenate(flat), np.concatenate(per_word)
    begin = np.cumsum(n) - n
    use = np.concatenate(uses)
    per_text = np.array([int(n[u].sum()) for u in uses], np.int64)
    return ids[_spread(begin[use], n[use])], per_text


def decode_ids(ids: list[int], pieces: list[bytes]) -> str:
    """The text of ids: pieces side by side, without the space that encoding put in front."""
    data = b"".join([pieces[i] for i in ids])
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _blocks(texts):
    """(first, last, texts) of runs of a batch that share one dictionary."""
    part, size, first = [], 0, 0
    for j, t in enumerate(texts):
        part.append(t)
        size += len(t) if t else 0
        if size > BLOCK_BYTES:
            yield first, j + 1, part
            part, size, first = [], 0, j + 1
    if part:
        yield first, first + len(part), part


def _encoder(shared, text_at: int):
    def run(batches):
        index = PieceIndex(Vocab(**shared.value))
        for batch in batches:
            texts = (x.as_py() for x in batch.column(text_at).cast(pa.binary()))
            for a, b, part in _blocks(texts):
                ids, n = encode_texts(part, index)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids, pa.int32()),
                    mask=pa.array([t is None for t in part]))
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, lists],
                                                 names=[*batch.schema.names, "ids"])
    return run


def encode(docs: DataFrame, model: str = DEFAULT_MODEL, text_col: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of each text as array<int> ``name`` (replacing a column of that name); no shuffle.

    A null text has null ids, an empty one no ids.  Of equally good
    segmentations the one whose last piece is shortest is taken.  Whole texts
    are encoded, however long; repeated rows each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(load_vocab(model)))  # 32,000 pieces
    docs = docs.select(*[quoted(c).alias(c) for c in docs.columns if c.lower() != name.lower()])
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    ddl = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields)) + ", ids array<int>"
    return inner.mapInArrow(lean(_encoder(shared, docs.columns.index(text_col))), ddl).toDF(*docs.columns, name)


def _round(shared):
    def run(batches):
        vocab = Vocab(**shared.value)
        index = PieceIndex(vocab)
        for batch in batches:
            texts = (x.as_py() for x in batch.column(1).cast(pa.binary()))
            for a, b, part in _blocks(texts):
                ids, n = encode_texts(part, index)
                ends = np.cumsum(n)
                same = [t is None or decode_ids(ids[e - k:e].tolist(), vocab.pieces).encode("utf-8") == t
                        for t, e, k in zip(part, ends, n)]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()),
                    mask=pa.array([t is None for t in part]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), lists, pa.array(same, pa.bool_())],
                    names=["id", "n_tokens", "ids", "round_trip"])
    return run


def encode_and_check(docs: DataFrame, model: str = DEFAULT_MODEL, text_col: str = "text",
                     id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids, round_trip): encode every text, decode the ids, compare the bytes.

    A null text has 0 tokens, null ids and counts as given back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(load_vocab(model)))
    return docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("t")).mapInArrow(
        lean(_round(shared)), "id long, n_tokens long, ids array<int>, round_trip boolean").withColumnRenamed("id", id_col)


def _decoder(shared):
    def run(batches):
        pieces = shared.value["pieces"]
        for batch in batches:
            texts = [None if x is None else decode_ids(x, pieces) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "t"])
    return run


def decode(encoded: DataFrame, model: str = DEFAULT_MODEL, ids_col: str = "ids", id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, text) of rows with piece ids; null ids give a null text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vars(load_vocab(model)))
    return encoded.select(quoted(id_col).cast("long").alias("id"), quoted(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        _decoder(shared), "id long, t string").toDF(id_col, text_col)

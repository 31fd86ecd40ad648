"""Unigram token counts by dynamic programming over a trie of pre-tokens.

The forward score of a position depends only on the characters before it, so
all pre-tokens that share a prefix share its scores.  The distinct
pre-tokens of a block are put in a trie and walked depth first: the scores on
the current path are kept, each trie node is scored once, and the count of
pieces on the best path is stored at the terminal nodes.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from fieldbook.llm.common import quoted
from fieldbook.llm.vocab import DEFAULT_MODEL, Vocab, load_vocab, pretokens

BLOCK_BYTES = 8 << 20  # text that shares one trie, so its memory is bounded


def trie_counts(words: list[bytes], scores: dict[str, float], longest: int, byte_score: float) -> dict[bytes, int]:
    """Number of pieces on the best path of each distinct pre-token.

    Sorted order is the depth-first order of the trie: the common prefix with
    the word before is the path that stays, everything after it is new nodes.
    """
    counts: dict[bytes, int] = {}
    path = ""  # characters from the root to the current node
    best, used = [0.0], [0]  # forward score and piece count at every node of the path
    for word, text in sorted(((w, w.decode("utf-8", "surrogateescape")) for w in words), key=lambda x: x[1]):
        n, shared = len(text), 0
        top = min(n, len(path))
        while shared < top and text[shared] == path[shared]:
            shared += 1
        del best[shared + 1:], used[shared + 1:]
        for end in range(shared + 1, n + 1):
            char = text[end - 1]
            if char in scores:
                top_score, top_used = best[end - 1] + scores[char], used[end - 1] + 1
            else:
                size = len(char.encode("utf-8", "surrogateescape"))
                top_score, top_used = best[end - 1] + size * byte_score, used[end - 1] + size
            for begin in range(end - 2, max(-1, end - 1 - longest), -1):
                s = scores.get(text[begin:end])
                if s is not None and best[begin] + s > top_score:
                    top_score, top_used = best[begin] + s, used[begin] + 1
            best.append(top_score)
            used.append(top_used)
        path = text
        counts[word] = used[n]
    return counts


def _counter(shared):
    def run(batches):
        scores, longest, byte_score = shared.value
        known: dict[bytes, int] = {}

        def flush(rows):
            fresh = {w for _, words in rows for w in words if w not in known}
            known.update(trie_counts(list(fresh), scores, longest, byte_score))
            out = pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()),
                 pa.array([sum(known[w] for w in words) for _, words in rows], pa.int64()),
                 pa.array([len(words) for _, words in rows], pa.int64())], names=["id", "n_tokens", "n_pretokens"])
            if len(known) > 1_000_000:
                known.clear()
            return out

        for batch in batches:
            rows, size = [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                data = text.as_py() or b""
                rows.append((i, pretokens(data)))
                size += len(data)
                if size > BLOCK_BYTES:
                    yield flush(rows)
                    rows, size = [], 0
            if rows:
                yield flush(rows)
    return run


def _payload(vocab: Vocab) -> tuple[dict[str, float], int, float]:
    scores = {p.decode("utf-8"): s for p, s in vocab.scores.items()}
    return scores, max(map(len, scores)), vocab.byte_score


def token_counts(docs: DataFrame, model: str = DEFAULT_MODEL, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, n_pretokens) of every row, over whole texts; no shuffle.

    Null and empty texts have 0 tokens; bytes that are no UTF-8 are spelt by
    their byte pieces, one token each; repeated rows are counted each; of
    equally good segmentations the one whose last piece is shortest counts.
    Extra columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_payload(load_vocab(model)))  # 32,000 pieces
    return docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).cast("string").alias("t")).mapInArrow(
        _counter(shared), "id long, n_tokens long, n_pretokens long").withColumnRenamed("id", id_col)

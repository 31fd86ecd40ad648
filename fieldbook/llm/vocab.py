"""Pieces and unigram scores of a SentencePiece model file.

The public model's pieces stand in merge order, that is, roughly by falling
frequency.  Nothing is trained here: the unigram score of the r-th ordinary
piece (r = 1, 2, ...) follows from its rank by Zipf's law,
ln(1 / (r * H)), with H the sum of 1/r over all pieces.  A character without
a piece of its own is spelt in UTF-8 bytes, each with the least score
minus 10, as SentencePiece scores unknown pieces.

Spaces are the model's U+2581, and a text begins with one space.  A U+2581
in the text itself is spelt in bytes, so decoding gives every text back
exactly.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

import numpy as np

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
META = "▁"
#: a run of spaces and what follows it up to the next space: no piece crosses its ends
PRETOKEN = re.compile(rb" *[^ ]+| +$")


@dataclass
class Vocab:
    pieces: list[bytes]  # by id; control pieces are empty, byte pieces are their byte
    scores: dict[bytes, float]  # ordinary pieces, U+2581 written as a space
    ids: dict[bytes, int]
    byte_ids: list[int]
    byte_score: float


def load_vocab(path: str = DEFAULT_MODEL) -> Vocab:
    """Read the model file (on the driver; tasks get the pieces by broadcast)."""
    import sentencepiece

    if not os.path.exists(path):
        raise FileNotFoundError(path)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ids, byte_ids = [], {}, [0] * 256
    for i in range(sp.get_piece_size()):
        text = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(text[3:5], 16)
            byte_ids[value] = i
            pieces.append(bytes([value]))
        elif sp.is_control(i) or sp.is_unknown(i):
            pieces.append(b"")
        else:
            data = text.replace(META, " ").encode()
            pieces.append(data)
            ids[data] = i
    total = float(np.sum(1.0 / np.arange(1, len(ids) + 1)))
    scores = {p: float(-np.log((r + 1) * total)) for r, p in enumerate(sorted(ids, key=ids.get))}
    return Vocab(pieces, scores, ids, byte_ids, min(scores.values()) - 10.0)


def pretokens(text: bytes) -> list[bytes]:
    """The pre-tokens of a text, the leading space added; their concatenation is that text."""
    if not text:
        return []
    if text[0] != 32 and text[-1] != 32 and b"  " not in text:
        return [b" " + w for w in text.split(b" ")]
    return PRETOKEN.findall(b" " + text)

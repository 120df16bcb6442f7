"""Pieces of a SentencePiece model file, read on the driver and sent with the tasks.

The file's path is always a parameter.
"""

from __future__ import annotations

from typing import NamedTuple

SPACE = "▁"  # how pieces write a space


class Pieces(NamedTuple):
    """``text`` and ``score`` of the pieces that may be matched, by ``id``;
    ``byte`` has the id of each byte's piece; ``unknown`` the id of the rest."""

    text: tuple[str, ...]
    score: tuple[int, ...]
    id: tuple[int, ...]
    byte: tuple[int, ...]
    unknown: int


def load_pieces(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    usual = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
    scores = [model.get_score(i) for i in usual]
    # Sums of whole numbers are exact and do not depend on the order.
    unit = 1 if all(s == int(s) for s in scores) else 1 << 16
    byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
    return Pieces(
        tuple(model.id_to_piece(i) for i in usual),
        tuple(round(s * unit) for s in scores),
        tuple(usual),
        tuple(byte[b] for b in range(256)) if len(byte) == 256 else (),
        model.unk_id(),
    )

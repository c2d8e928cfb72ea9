"""Sentencepiece BPE models as tables: pieces, scores and what the operators may rely on."""

from __future__ import annotations

import functools
import re

import public_tokenizers
import sentencepiece

MARK = "▁"  # stands for a space in pieces (fixed value)
MODEL = "piece_bpe_32k.model"


def default_model() -> str:
    return public_tokenizers.path(MODEL)


@functools.lru_cache(maxsize=4)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model; ValueError if it changes texts or has pieces that cross a word's mark."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "  a  é́ ﬁ　\t½\n x "
    if model.normalize(probe) != (MARK + probe).replace(" ", MARK):
        raise ValueError("the model normalizes texts")
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in ordinary(model)):
        raise ValueError("the model has pieces that cross a word's mark")
    return model


def ordinary(model: sentencepiece.SentencePieceProcessor) -> dict[str, int]:
    """Pieces that text can merge to, with their ids."""
    def special(i: int) -> bool:
        return model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)

    return {model.id_to_piece(i): i for i in range(model.get_piece_size()) if not special(i)}


def marked(texts: list[bytes]) -> list[bytes]:
    """Texts as the model sees them, with a space for each mark: one more in front, if not empty."""
    mark = MARK.encode()
    return [b" " + t.replace(mark, b" ") if t else t for t in texts]

"""Pieces of a SentencePiece model, and the places where no piece can cross."""

from __future__ import annotations

import re
from functools import lru_cache
from pathlib import Path

import sentencepiece
from sentencepiece import sentencepiece_model_pb2

META = "▁"


def public_model_path(name: str = "piece_bpe_32k.model") -> str:
    """A file of the installed vocabulary package; the library is on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


class PieceModel:
    """Ids, scores and bytes of the pieces; units are the parts of a text that no piece crosses.

    Built for models that leave text as it is (identity normalisation), put one meta space in front and
    fall back to bytes. Between two characters that stand side by side in no piece nothing can be joined,
    whatever the algorithm: here that holds before a meta space that follows another character, and on
    both sides of every character that is in no piece of two or more. Both are checked against the
    vocabulary, not taken for granted.
    """

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(Path(path).read_bytes())
        spec = proto.normalizer_spec
        if spec.name != "identity" or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only models without normalisation and with a leading meta space")
        self.path, self.ids, self.scores, self.bytes_of = path, {}, {}, []
        self.byte_ids = [-1] * 256
        for i, p in enumerate(proto.pieces):
            if p.type in (1, 4):
                self.ids[p.piece], self.scores[p.piece] = i, p.score
            raw = p.piece.replace(META, " ").encode()
            if p.type == 6:
                value = int(p.piece[3:5], 16)
                self.byte_ids[value], raw = i, bytes([value])
            self.bytes_of.append(b"" if p.type in (2, 3) else raw)
        if min(self.byte_ids) < 0:
            raise ValueError("only models with byte pieces")
        self.longest = max(map(len, self.ids))
        self.least = min(s for p, s in self.scores.items() if s > -1e6)
        inner = {c for p in self.ids if len(p) > 1 for c in p}
        if any(META in p.lstrip(META) for p in self.ids):
            raise ValueError("a piece has a meta space after another character")
        alone = "".join(c for c in "\t\n\v\f\r" if c not in inner)
        stop = re.escape(alone)
        self.unit = re.compile(f"[{stop}]|{META}*[^{META}{stop}]+|{META}+" if alone else f"{META}*[^{META}]+|{META}+")

    def units(self, text: str) -> list[str]:
        """The parts of a text with its leading meta space; an empty text has none."""
        return self.unit.findall(META + text.replace(" ", META)) if text else []


@lru_cache(maxsize=4)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


@lru_cache(maxsize=4)
def library(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)

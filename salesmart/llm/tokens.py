"""Token ids of whole texts by a public tokenizer file, with a piece cache.

The byte-level vocabulary never merges across the place between a character
that is no white space and a single space, nor around a single line break
between such characters. So a text can be cut there, and each distinct piece
is encoded once: its ids are kept as little-endian uint32 bytes. A text with
any other white space, or with a special token's string, goes to the
``tokenizers`` library whole. Distinct pieces are encoded by ``tiktoken`` with
ranks taken from the same file where its merges stand in the order of their
ids (then both give the same ids; tested), by ``tokenizers`` otherwise.
"""

from __future__ import annotations

import functools
import json
from array import array

import numpy as np

#: Pieces kept by one Python worker in each of two generations: a full young
#: generation becomes the old one, whose pieces in use move back.
CACHE_PIECES = 250_000
#: Strings that make a text odd: white space other than single spaces and
#: single line breaks between other characters.
_ODD = ["  ", " \n", "\n ", "\n\n", *(chr(c) for c in range(0x3001) if chr(c).isspace() and c not in (10, 32))]


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others follow from U+0100 on, in order."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _ranks(model: dict) -> dict[bytes, int] | None:
    """Token bytes to ids, if a merge's place follows from its result's id."""
    vocab = model["vocab"]
    merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    ids = [vocab.get(m.replace(" ", "", 1)) for m in merges]
    if None in ids or any(a >= b for a, b in zip(ids, ids[1:], strict=False)):
        return None
    alphabet = _byte_of_char()
    made = [*alphabet, *(m.replace(" ", "", 1) for m in merges)]
    return {bytes(alphabet[c] for c in token): vocab[token] for token in made if token in vocab}


class PieceCache(dict):
    def __init__(self, prefix: str, encode, most: int = CACHE_PIECES):
        self.prefix, self.encode, self.most = prefix, encode, most
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(self.prefix + piece)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """``encode(text)`` gives a text's ids as little-endian uint32
    bytes, as ``Tokenizer.encode(text, add_special_tokens=False)`` has them."""

    def __init__(self, tokenizer_json: str):
        self.source = tokenizer_json
        spec = json.loads(tokenizer_json)
        self.n_ids = 1 + max([*spec["model"]["vocab"].values(), *(x["id"] for x in spec.get("added_tokens", []))])
        self.specials = [x["content"] for x in spec.get("added_tokens", [])]
        ranks = _ranks(spec["model"])
        encode = self._whole
        if ranks is not None:
            import tiktoken
            from public_tokenizers import PATTERN

            core = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            encode = lambda text: array("I", core(text)).tobytes()
        self.at_start, self.after_space = PieceCache("", encode), PieceCache(" ", encode)
        self.line_break = encode("\n")

    @functools.cached_property
    def tokenizer(self):
        """The library's own object, made when a text first needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.source)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _is_odd(self, text: str) -> bool:
        return text[0] in " \n" or text[-1] in " \n" or any(x in text for x in _ODD) or any(x in text for x in self.specials)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self._is_odd(text):
            return self._whole(text)
        first, rest = self.at_start.__getitem__, self.after_space.__getitem__
        lines = [line.split(" ") for line in text.split("\n")]
        return self.line_break.join([first(p[0]) + b"".join(map(rest, p[1:])) for p in lines])


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's text, read on the driver (its size is fixed)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


_encoders: dict[int, Encoder] = {}


def encoder(held) -> Encoder:
    """This worker's encoder for a broadcast tokenizer file. Its pieces stay for
    the worker's next tasks: encoding them anew in each costs a third more."""
    key = hash(held.value)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(held.value)
    return _encoders[key]

"""Byte-level BPE ids of whole texts, by the library, in pieces that can be cut safely.

The vocabulary's pattern never lets a piece run on from a non-space character into a following space, nor a run of
letters or digits into punctuation, so a text may be cut before every such space or mark without changing
its ids. Most pieces come back again and again; short ones are encoded once and looked up afterwards.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterable

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"
#: A cut stands before a space after a non-space. Python's \s holds every space of the pattern.
SPACE_CUT = re.compile(r"(?<=\S)(?= )")
#: Another stands where a letter or digit meets a mark other than the apostrophe of contractions. Both sides list
#: characters of which all versions of the pattern's classes say the same.
_LETTERS = r"0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u3041-\u3096\u4e00-\u9fa5\uac00-\ud7a3"
_MARKS = r"!-&(-/:-@\[-^`{-~\u3001\u3002\uff01\uff08\uff09\uff0c\uff1a\uff1b\uff1f"
CUT = re.compile(rf"(?<=\S)(?= )|(?<=[{_LETTERS}])(?=[{_MARKS}])")
#: A string that begins so may be a special token, which must stay whole.
SPECIAL_START = "<|"
SHORT = 64  # characters of a piece that is remembered
KEEP_BYTES = 32 << 20  # of pieces and what Python needs for each; then a worker starts anew
PIECE_BYTES = 150
BATCH_BYTES = 1 << 20


def load(path: str | None = None) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))


def cut(text: str) -> list[str]:
    return (SPACE_CUT if SPECIAL_START in text else CUT).split(text)


class Encoder:
    """Remembers what ``value`` makes of the ids of each short piece, KEEP_BYTES of them at most."""

    def __init__(self, value, path: str | None = None):
        self.tokenizer, self.value, self.known, self.held = load(path), value, {}, 0

    def encode(self, texts: Iterable[str]) -> list[list]:
        """For each text the values of its pieces, in order."""
        parts = [cut(t) for t in texts]
        if self.held > KEEP_BYTES:
            self.known, self.held = {}, 0
        known, once = self.known, {}  # what is not kept is forgotten with this call
        fresh = list({p for cuts in parts for p in cuts if p not in known})
        at = 0
        while at < len(fresh):  # batches of about as many bytes each
            to, held = at, 0
            while to < len(fresh) and (to == at or held < BATCH_BYTES):
                held += len(fresh[to].encode())
                to += 1
            ids = self.tokenizer.encode_batch_fast(fresh[at:to], add_special_tokens=False)
            for piece, found in zip(fresh[at:to], ids, strict=True):
                once[piece] = self.value(found.ids)
            at = to
        out = [[known[p] if p in known else once[p] for p in cuts] for cuts in parts]
        for piece, value in once.items():
            if len(piece) <= SHORT and self.held <= KEEP_BYTES:
                known[piece] = value
                self.held += len(piece.encode()) + PIECE_BYTES
        return out


#: The same vocabulary as ranks, for a faster library. It is used for texts of these characters only, on
#: which all versions of the pattern's classes agree, and never where the special token's string occurs.
RANKS = "byte_bpe_50k.tiktoken"
PLAIN = re.compile(r"[\t\n\r -~\u00a1-\u00ac\u00ae-\u024f]*")
SPECIAL = "<|endoftext|>"


class Ids:
    """Little-endian 32-bit ids of whole texts as bytes."""

    def __init__(self, path: str | None = None, ranks: str | None = None):
        self.tokenizer, self.fast = load(path), None
        if path is None or ranks:  # another vocabulary needs its own ranks
            with open(ranks or public_tokenizers.path(RANKS), "rb") as f:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}
            )

    def encode(self, text: str) -> bytes:
        if self.fast and SPECIAL not in text and PLAIN.fullmatch(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

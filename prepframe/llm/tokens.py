"""Token ids of whole texts with a public tokenizer file, equal to the tokenizers library's.

The vocabulary is read from the tokenizer's own file.  Two kinds of BPE files take a
faster core (ranks by bytes) that gives the same ids; texts with special-token strings,
very long unsplit runs or unusual characters, and all other files, go through the library.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from functools import lru_cache

import numpy as np

CACHE = 600_000
LONG_RUN = 1000  # characters without a split point: the library's heap is faster from here on
# Split pattern of byte-level BPE files.
BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TAIL = ".,;:!?"  # closing signs that are cut from a word as one piece


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _stand_ins() -> dict[str, int]:
    """Printable characters that stand for the 256 bytes in byte-level vocabularies."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {b: chr(b) for b in keep}
    for i, b in enumerate(x for x in range(256) if x not in sign):
        sign[b] = chr(256 + i)
    return {c: b for b, c in sign.items()}


def _pack(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


class Encoder:
    """``encode(text)``: little-endian unsigned 32-bit ids without added special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            self.file = json.load(f)
        self.special = [t["content"] for t in self.file.get("added_tokens", [])]

    def library(self, text: str) -> bytes:
        return _pack(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def encode(self, text: str) -> bytes:
        return self.library(text)

    def ranks(self, suffix: str = "", mark: bytes = b"") -> dict[bytes, int] | None:
        """Bytes of every token and its id, if ids rank the tokens as the merges do."""
        back, model = _stand_ins(), self.file["model"]
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.special}

        def raw(t: str) -> bytes:
            whole = bool(suffix) and t.endswith(suffix)
            return bytes(back[c] for c in (t[: -len(suffix)] if whole else t)) + mark * whole

        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            return None
        return {raw(t): i for t, i in vocab.items()}


def _core(ranks: dict[bytes, int], pattern: str):
    import tiktoken

    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def has_long_run(text: str) -> bool:
    """Whether a piece between split points may be very long (white space counts as well)."""
    return len(text) > LONG_RUN and (max(map(len, text.split(" "))) >= LONG_RUN or " " * LONG_RUN in text)


class ByteLevelEncoder(Encoder):
    """Byte-level BPE without normaliser."""

    def __init__(self, path: str):
        super().__init__(path)
        ranks = self.ranks()
        self.core = _core(ranks, BYTE_LEVEL) if ranks else None

    def encode(self, text: str) -> bytes:
        if self.core is None or has_long_run(text) or any(s in text for s in self.special):
            return self.library(text)
        return self.core.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()


class WordEncoder(Encoder):
    """BPE with word ends, lower case, white space dropped; remembers the ids of words.

    A byte that no text contains marks the end of a word, so that the vocabulary's
    word-final tokens are plain byte strings.
    """

    MARK = b"\xff"

    def __init__(self, path: str):
        super().__init__(path)
        ranks = self.ranks("</w>", self.MARK)
        self.core = _core(ranks, r"[\s\S]+") if ranks and sys.byteorder == "little" and array("I").itemsize == 4 else None
        self.words: dict[str, bytes] = {}

    def _piece(self, word: str) -> bytes:
        return array("I", self.core._encode_single_piece(word.encode() + self.MARK)).tobytes()

    def word(self, w: str) -> bytes:
        """Ids of a chunk without white space."""
        head = w.rstrip(TAIL)
        low, tail = head.lower(), w[len(head) :]
        if self.core is None or len(w) > 200 or (low and not (low.isalpha() and (low.isascii() or ord(max(low)) < 0x250))):
            got = self.library(w)
        else:
            got = (self._piece(low) if low else b"") + (self._piece(tail) if tail else b"")
        if len(w) <= 200:
            if len(self.words) > CACHE:
                self.words.clear()
            self.words[w] = got
        return got

    def encode(self, text: str) -> bytes:
        # Python also splits at four control characters that the library keeps.
        if any(s in text for s in self.special) or (not text.isprintable() and re.search("[\x1c-\x1f]", text)):
            return self.library(text)
        known = self.words.get
        return b"".join([known(w) or self.word(w) for w in text.split()])


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, norm, pre = file["model"], file.get("normalizer"), file.get("pre_tokenizer") or {}
    if model.get("type") == "BPE" and not model.get("ignore_merges") and not model.get("dropout"):
        if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            return ByteLevelEncoder(path)
        kinds = [n.get("type") for n in (norm or {}).get("normalizers", [])]
        if model.get("end_of_word_suffix") == "</w>" and kinds == ["NFC", "Replace", "Lowercase"]:
            return WordEncoder(path)
    return Encoder(path)


@lru_cache(maxsize=4)
def byte_table(path: str) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary."""
    from tokenizers import Tokenizer

    back = _stand_ins()
    t = Tokenizer.from_file(path)
    added = {i: a.content.encode() for i, a in t.get_added_tokens_decoder().items()}
    table = []
    for i in range(t.get_vocab_size(with_added_tokens=True)):
        token = t.id_to_token(i)
        table.append(added[i] if i in added else bytes(back[c] for c in token or ""))
    return table

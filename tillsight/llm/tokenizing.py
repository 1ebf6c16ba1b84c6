"""Token ids of whole texts by a public tokenizer, with a bounded word cache.

Only for use inside tasks. ``byte_level(name)`` encodes as the tokenizers
library does for a byte-level BPE file. A blank before a non-blank always starts a
new pre-token, so a text is cut there, and the ids of each part are kept in a
cache of bounded size. Parts outside the cache go through tiktoken if the file's
merge ranks are provably its ids, which makes both libraries' merges the same;
texts with a special string, and other kinds of files, go to tokenizers itself.
Where too many parts are new, the cache costs more than it saves, and whole texts
go through tiktoken; the ids are the same.
"""

from __future__ import annotations

import array
import functools
import json
import os
import re
import sys

import numpy as np

#: Characters of parts that a cache holds before it is emptied.
CACHE_CHARS = 3_000_000
#: Parts that are looked up before the cache is judged, and the share of new ones beyond which it is left.
TRIED_PARTS, MOST_NEW = 200_000, 0.15
_BLANKS = re.compile(r" \s")
_RUNS = re.compile(r"\s\s")
#: The pre-token pattern of byte-level BPE files with ``use_regex`` (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: It without its look-ahead, which decides only where a run of blanks ends: the same parts of texts whose runs are single characters.
PLAIN_PATTERN = PATTERN.replace(r"|\s+(?!\S)", "")


def tokenizer_path(name: str) -> str:
    """``name`` itself if it is a file, else the public tokenizer of that name."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_chars() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, rest = {chr(b): b for b in plain}, 0
    for b in range(256):
        if b not in plain:
            table[chr(256 + rest)] = b
            rest += 1
    return table


def _ranks(path: str) -> dict[bytes, int] | None:
    """Merge ranks of a plain byte-level BPE file, if its ids follow the order of its merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if (model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True)
            or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")):
        return None
    chars, vocab, special = _byte_chars(), model["vocab"], {t["content"] for t in spec.get("added_tokens", ())}
    for i, merge in enumerate(model["merges"]):
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        if vocab.get(a + b) != 256 + i:
            return None
    return {bytes(chars[c] for c in token): i for token, i in vocab.items() if token not in special}


class ByteLevel:
    def __init__(self, name: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        path = tokenizer_path(name)
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f).get("added_tokens", ())]
        ranks = _ranks(path)
        self.fast = self.plain = None
        if ranks is not None:
            import tiktoken

            self.fast, self.plain = (tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (PATTERN, PLAIN_PATTERN))
            self.width = np.zeros(max(ranks.values()) + 1, np.int64)  # bytes of each id
            for token, i in ranks.items():
                self.width[i] = len(token)
        self.cache: dict[str, bytes] = {}
        self.held = 0
        self.tried = self.new = 0
        self.pays = True

    def _part(self, part: str) -> bytes:
        ids = array.array("I", (self.fast if _RUNS.search(part) else self.plain).encode_ordinary(part))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _judge(self, parts: int, new: int) -> None:
        """Leave the cache if too many of the last parts were outside it."""
        self.tried += parts
        self.new += new
        if self.tried >= TRIED_PARTS:
            self.pays = self.new <= MOST_NEW * self.tried
            self.tried = self.new = 0
            if not self.pays:
                self.cache.clear()

    def _learn(self, parts: set[str]) -> None:
        """Encode new parts in one call; the ids' widths in bytes tell where each part ends."""
        if "" in parts:  # a blank at the end of a text
            self.cache[""] = self._part(" ")
            parts.discard("")
        order = list(parts)
        ids = np.frombuffer(self._part(" " + " ".join(order)) if order else b"", "<u4")
        ends = np.cumsum(self.width[ids])
        wanted = np.cumsum(np.fromiter((len(p.encode("utf-8", "surrogatepass")) + 1 for p in order), np.int64, len(order)))
        cuts = np.searchsorted(ends, wanted) + 1
        if len(order) and not np.array_equal(ends[cuts - 1], wanted):
            raise ValueError("a token crosses a blank")
        at = 0
        for part, cut in zip(order, cuts.tolist(), strict=True):
            self.cache[part] = ids[at:cut].tobytes()
            self.held += len(part) + 8
            at = cut

    def ids(self, text: str) -> bytes:
        """The text's ids as little-endian 32-bit numbers."""
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not self.pays or _BLANKS.search(text):
            return self._part(text)
        first, *parts = text.split(" ")
        cache = self.cache
        try:
            rest = b"".join(map(cache.__getitem__, parts))
            new = 0
        except KeyError:
            if self.held > CACHE_CHARS:
                cache.clear()
                self.held = 0
            missing = {p for p in parts if p not in cache}
            new = len(missing)
            self._learn(missing)
            rest = b"".join(map(cache.__getitem__, parts))
        self._judge(len(parts), new)
        return self._part(first) + rest if first else rest


@functools.lru_cache(maxsize=4)
def byte_level(name: str) -> ByteLevel:
    return ByteLevel(name)

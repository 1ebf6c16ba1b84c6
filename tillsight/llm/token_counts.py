"""Token counts with a whole-token shortcut.

For a sentencepiece BPE model whose pieces never hold a blank after another
character, no merge crosses the blank before a word, so a text's count is the
sum over its blank-started parts. Before any text is read, each vocabulary
string that starts with one blank is encoded alone; those that give exactly one
id are proved whole tokens. A part that is one of them counts 1. Only the other
parts are merged, by the library itself, and remembered in a bounded cache.
Models without that property, and byte-level JSON files, count whole texts.

Defined results: a null or empty text has 0 tokens; rows are counted one by one.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenizing import CACHE_CHARS, byte_level, tokenizer_path

BLANK = "▁"  # how sentencepiece writes a blank
_PART = re.compile(" +[^ ]*")
NORMAL, USER_DEFINED = 1, 4


class PieceCounter:
    def __init__(self, name: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        path = tokenizer_path(name)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        rule, pieces = proto.normalizer_spec, proto.pieces
        self.parted = (rule.name == "identity" and rule.add_dummy_prefix and not rule.remove_extra_whitespaces and rule.escape_whitespaces
                       and not rule.precompiled_charsmap and proto.trainer_spec.model_type == 2 and not proto.trainer_spec.treat_whitespace_as_suffix
                       and not any(p.type == USER_DEFINED or re.search(f"[^{BLANK}]{BLANK}", p.piece) for p in pieces))
        self.whole = self.prove(p.piece for p in pieces if p.type == NORMAL)
        self.known = dict.fromkeys(self.whole, 1)
        self.held = 0

    def prove(self, pieces) -> list[str]:
        """Vocabulary strings after their blank that the library encodes as that one token."""
        words = [p[1:] for p in pieces if len(p) > 1 and p[0] == BLANK and BLANK not in p[1:]]
        return [w for w, ids in zip(words, self.model.encode(words, num_threads=1), strict=True) if len(ids) == 1 and self.model.id_to_piece(ids[0]) == BLANK + w]

    def _learn(self, parts: list[str]) -> None:
        if self.held > CACHE_CHARS:
            self.known, self.held = dict.fromkeys(self.whole, 1), 0
        for part, ids in zip(parts, self.model.encode(parts, num_threads=1), strict=True):
            self.known[part] = len(ids)
            self.held += len(part) + 8
        if "" in parts:  # a single blank at the end of a text; the library adds no blank to an empty text
            self.known[""] = 1 if self.model.piece_to_id(BLANK) != self.model.unk_id() else len(self.model.encode(" ")) - 1

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.parted:
            return len(self.model.encode(text))
        text = text.replace(BLANK, " ")
        if "  " in text or text[0] == " ":
            parts = [p[1:] for p in _PART.findall(" " + text)]
        else:
            parts = text.split(" ")
        try:
            return sum(map(self.known.__getitem__, parts))
        except KeyError:
            self._learn([p for p in set(parts) if p not in self.known])
            try:
                return sum(map(self.known.__getitem__, parts))
            except KeyError:  # the cache was emptied in between
                self._learn([p for p in set(parts) if p not in self.known])
                return sum(map(self.known.__getitem__, parts))


class ByteCounter:
    def __init__(self, name: str) -> None:
        self.tokenizer = byte_level(name)

    def count(self, text: str) -> int:
        return len(self.tokenizer.ids(text)) // 4 if text else 0


@functools.lru_cache(maxsize=4)
def counter(name: str) -> PieceCounter | ByteCounter:
    return PieceCounter(name) if name.endswith(".model") else ByteCounter(name)


def count_tokens(docs: DataFrame, tokenizer: str = "piece_bpe_32k.model", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer).count
        for batch in batches:
            n = pa.array((count(t.as_py() or "") for t in batch.column("text")), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), n], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.col("text").cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long"
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)

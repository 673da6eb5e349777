"""Encoding with a SentencePiece model through a table of distinct chunks.

A text is cut into chunks at places that no piece of the model crosses: before a run of
white-space markers that follows another character, and around line ends and tabs where no
piece of several characters has them. Merges join neighbours into a piece of the
model only, so none crosses such a place and the chunks can be encoded one by one. Each
distinct chunk of a task is encoded and decoded once; a document's ids are its chunks' ids in
their order. The table is emptied when it reaches ``TABLE_LIMIT`` chunks or ``CHUNK_LIMIT``
bytes, which changes the time but not the result. If a model has pieces that cross markers,
whole texts are encoded.

NULL texts count as empty; an empty text has no ids, and decodes to the empty text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import pieces, texts

MARK = "▁"
TABLE_LIMIT = 400_000
CHUNK_LIMIT = 64 << 20


class ChunkCodec:
    """Encodes texts as the library does, by distinct chunks."""

    def __init__(self, model_file: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        model = self.model
        names = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        joined = set("".join(n for n in names if len(n) > 1))
        self.alone = "".join(c for c in "\n\t" if c not in joined)
        # Ids before a chunk that keep the library from taking it for the start of a text.
        self.lead = model.encode("\n")
        self.table: dict[str, tuple[str, int, str]] = {}
        self.held = 0
        self.pattern = None
        if self.alone and not any(MARK in n.lstrip(MARK) for n in names) and self._only_adds_a_mark():
            held = re.escape(self.alone)
            self.pattern = re.compile(rf"[ {MARK}]*[^ {MARK}{held}]+|[ {MARK}]+|[{held}]+")

    def _only_adds_a_mark(self) -> bool:
        """Whether the model puts one marker in front and otherwise leaves texts alone."""
        probe = "  éé ﬁ \u3000x  y\n\tz  "
        ids = self.model.encode(probe)
        return self.model.decode(ids) == probe and self.lead == self.model.encode("\nx")[: len(self.lead)]

    def _chunks(self, text: str) -> list[str]:
        """Chunks of a text with the marker that the library puts before it."""
        return self.pattern.findall(" " + text) if text else []

    def _fill(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.table]
        if self.table and (len(self.table) + len(new) > TABLE_LIMIT or self.held > CHUNK_LIMIT):
            self.table.clear()
            self.held, new = 0, list(chunks)
        skip = len(self.lead)
        ids = [x[skip:] for x in self.model.encode(["\n" + c for c in new], num_threads=1)]
        texts = self.model.decode([self.lead + x for x in ids], num_threads=1)
        self.held += sum(map(len, new))
        self.table.update(
            (c, (",".join(map(str, x)), len(x), t[1:])) for c, x, t in zip(new, ids, texts)
        )

    def encode(self, texts: list[str]) -> list[tuple[str, int, str]]:
        """Comma-joined ids, their number and the text decoded from them, of each text."""
        if self.pattern is None:
            rows = self.model.encode(texts, num_threads=1)
            back = [self.model.decode(ids) if ids else "" for ids in rows]
            return [(",".join(map(str, ids)), len(ids), t) for ids, t in zip(rows, back)]
        cut = [self._chunks(t) for t in texts]
        self._fill(set().union(*cut))
        found = []
        for chunks in cut:
            rows = [self.table[c] for c in chunks]
            decoded = "".join([r[2] for r in rows])
            found.append((",".join([r[0] for r in rows]), sum([r[1] for r in rows]), decoded[1:]))
        return found


def encode(docs: DataFrame, model_file: str, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of each row of ``docs``.

    ``with_ids`` adds ``ids``, the comma-joined ids, and ``decoded``. One pass over the rows,
    without a shuffle; memory holds one piece of a batch and the table.
    """
    source = texts(docs, key, text)
    more = ", ids string, decoded string" if with_ids else ""
    kind = source.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ChunkCodec(model_file)
        for piece in pieces(batches, text):
            rows = codec.encode(piece.column(text).to_pylist())
            columns = {
                key: piece.column(key),
                "n_tokens": pa.array([r[1] for r in rows], pa.int64()),
                "ids_sha256": [hashlib.sha256(r[0].encode()).hexdigest() for r in rows],
                "decoded_sha256": [hashlib.sha256(r[2].encode()).hexdigest() for r in rows],
            }
            if with_ids:
                columns |= {"ids": [r[0] for r in rows], "decoded": [r[2] for r in rows]}
            yield pa.RecordBatch.from_pydict(columns)

    return source.mapInArrow(run, schema)

"""SentencePiece encoding and decoding with a table of distinct marked words.

No piece of the models served here goes on past a whitespace marker that follows another
character (``pieces_stay_in_words`` checks it and ``encode`` refuses other models), so the pieces of a
text are the pieces of its marked words one after the other. A task segments each distinct
marked word (a run of markers and what follows up to the next marker) once and looks the words of its texts
up by position. The table lives in the task, with a bound on its entries: a text's words never leave
the task that read it, so nothing is shuffled; a lost executor costs only its own tasks.

Defined cases: a null or empty text has no pieces, only begin and end ids, and decodes to the empty
text. Texts of any length are encoded whole. Repeated rows are encoded one by one. Other columns of the
input are not read, whatever their names.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import small_batches

#: Entries after which a task starts its table anew.
TABLE_ENTRIES = 150_000
#: Longer words are segmented where they stand and not kept.
LONG_WORD = 256
_MARK = "▁"
_MARKED = re.compile(" +[^ ]*")


def pieces_stay_in_words(processor) -> bool:
    """Whether no piece holds a marker after another character and texts are not rewritten first."""
    inside = re.compile(f"[^{_MARK}]{_MARK}")
    same = all(processor.normalize(x) == _MARK + x.replace(" ", _MARK) for x in (" x", "  ﬁＡ ", "x  y\t "))
    return same and not any(inside.search(processor.id_to_piece(i)) for i in range(processor.vocab_size()))


def marked_words(text: str) -> list[str]:
    """The marked words of a text, each without its first marker, which the library adds again."""
    text = text.replace(_MARK, " ")
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return [x[1:] for x in _MARKED.findall(" " + text)]
    return text.split(" ") if text else []


class Table:
    """Ids (little-endian, 32 bits each) and decoded bytes of marked words."""

    def __init__(self, processor, most: int = TABLE_ENTRIES):
        self.processor, self.most = processor, most
        lone = processor.encode("x ")[len(processor.encode("x")) :]  # a marker that nothing follows
        self.start = {"": packed(lone)}, {"": b""}
        self.ids, self.decoded = map(dict, self.start)

    def add(self, words: set[str]) -> None:
        new = list(words - self.ids.keys())
        if len(new) + len(self.ids) > self.most:
            self.ids, self.decoded = map(dict, self.start)
            new = list(words - self.ids.keys())
        pieces = self.processor.encode(new)
        for word, ids, back in zip(new, pieces, self.processor.decode(pieces) if new else []):
            self.ids[word] = packed(ids)
            self.decoded[word] = back.encode()

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids without begin and end, decoded UTF-8) of each text."""
        split = [marked_words(text) for text in texts]
        words: set[str] = set()
        words.update(*split)
        self.add({word for word in words if len(word) <= LONG_WORD})
        long = {word for word in words if len(word) > LONG_WORD}
        if not long:
            return [(b"".join(map(self.ids.__getitem__, x)), b" ".join(map(self.decoded.__getitem__, x))) for x in split]
        out = []
        for text in split:
            ids, back = [], []
            for word in text:
                if word in long:
                    pieces = self.processor.encode(word)
                    ids.append(packed(pieces))
                    back.append(self.processor.decode(pieces).encode())
                else:
                    ids.append(self.ids[word])
                    back.append(self.decoded[word])
            out.append((b"".join(ids), b" ".join(back)))
        return out


def packed(ids: list[int]) -> bytes:
    values = array("I", ids)
    if values.itemsize != 4 or array("H", [1]).tobytes() != b"\x01\x00":
        raise RuntimeError("32-bit little-endian integers are needed")
    return values.tobytes()


def encode(docs: DataFrame, doc_id: str, text: str, model: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row; ids are packed as little-endian unsigned 32-bit integers,
    begin and end ids included. ``model`` is read on the driver and sent to the tasks with the plan's broadcast."""
    import sentencepiece

    with open(model, "rb") as file:
        proto = file.read()
    if not pieces_stay_in_words(sentencepiece.SentencePieceProcessor(model_proto=proto)):
        raise ValueError("pieces of this model can cross whitespace markers")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(proto)
    kind = docs.schema[doc_id].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        table = Table(processor)
        begin, end = packed([processor.bos_id()]), packed([processor.eos_id()])
        for batch in batches:
            for start, texts in K.slices(batch.column(1), 2 << 20):
                rows = table.encode([x or "" for x in texts.to_pylist()])
                ids = pa.array([begin + x + end for x, _ in rows], pa.binary())
                back = pa.array([x.decode() for _, x in rows], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), ids, back], names=["doc_id", "ids", "decoded"]
                )

    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(encoded, f"doc_id {kind}, ids binary, decoded string")

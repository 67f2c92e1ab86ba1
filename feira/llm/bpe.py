"""Byte-level BPE through a sentencepiece model that is written straight from a rank file."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
from sentencepiece import sentencepiece_model_pb2 as layout

# A task that remembers more pieces than this starts anew.
REMEMBERED = 600_000
# Pre-tokens of one call of the library, which costs more than encoding a short one.
TOGETHER = 256
# Stands between them: no byte has this letter, so it becomes the unknown piece and no merge crosses it.
APART = "\ufdd0"
# Texts whose pre-tokens are encoded together, in code points.
CHUNK = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_letters() -> list[str]:
    """One visible letter for each byte: itself where Latin-1 prints it, else a letter from U+0100 on."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    later = iter(range(0x100, 0x200))
    return [chr(b) if b in printed else chr(next(later)) for b in range(256)]


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose merges go in order of rank.

    Pieces are the tokens with a letter per byte, scored by negative rank; normalisation is the
    identity and adds nothing. Id 0 is the unknown piece, id n + 1 the token of the n-th lowest rank.
    """
    letters = byte_letters()
    model = layout.ModelProto()
    model.trainer_spec.model_type = layout.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(ranks) + 1
    model.trainer_spec.unk_id = 0
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    model.pieces.add(piece="<unk>", score=0, type=layout.ModelProto.SentencePiece.UNKNOWN)
    for token, rank in sorted(ranks.items(), key=lambda entry: entry[1]):
        model.pieces.add(piece="".join([letters[b] for b in token]), score=-float(rank))
    return model.SerializeToString()


class Codec:
    """Encodes and decodes whole texts; one per task.

    With `cut`, a text is cut at its spaces and the ids of each piece are remembered. That is right
    for a pattern that allows a space at the start of a match only, unless the match is all white
    space: then no match crosses a space between two other characters. Texts with other spaces are
    not cut.
    """

    def __init__(self, model: bytes, ranks: tuple[int, ...], pattern: str, cut: bool):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        self.cut = cut
        letters = byte_letters()
        self.latin = str.maketrans({chr(b): letter for b, letter in enumerate(letters)})
        self.names = ["\n", *map(str, ranks)]
        back = {letter: b for b, letter in enumerate(letters)}
        self.tokens = {
            str(rank): bytes([back[c] for c in self.processor.id_to_piece(i + 1)])
            for i, rank in enumerate(ranks)
        }
        self.known: dict[str, str | None] = {}

    def _ranks(self, parts: list[str]) -> dict[str, str]:
        """The ids of each pre-token as text."""
        names, found = self.names, []
        for group in range(0, len(parts), TOGETHER):
            mapped = [p.encode().decode("latin-1").translate(self.latin) for p in parts[group : group + TOGETHER]]
            ids = self.processor.encode(APART.join(mapped), num_threads=1)
            found += " ".join([names[i] for i in ids]).split(" \n ")
        return dict(zip(parts, found, strict=True))

    def _whole(self, texts: list[str]) -> list[str]:
        """The ids of texts that are not cut."""
        rows = [self.split(text) for text in texts]
        ranks = self._ranks(list({part for row in rows for part in row}))
        return [" ".join([ranks[part] for part in row]) for row in rows]

    def _learn(self, pieces: set[str]) -> None:
        """Remember what a space and each piece encode to; None where the piece must not be cut off."""
        known = self.known
        plain = []
        for piece in pieces:
            if not piece or piece[0].isspace() or piece[-1].isspace():
                known[piece] = None
            else:
                plain.append(piece)
        for piece, ids in zip(plain, self._whole([" " + piece for piece in plain])):
            known[piece] = ids

    def encode(self, texts: list[str]) -> list[str]:
        """The ids of each text, as decimals with a space between."""
        if not self.cut:
            return self._whole(texts)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        rows = [text.split(" ") for text in texts]
        self._learn({piece for row in rows for piece in row[1:] if piece not in known})
        heads = self._whole([row[0] for row in rows])
        done = []
        for text, row, head in zip(texts, rows, heads):
            ids = [known[piece] for piece in row[1:]]
            if not ids:
                done.append(head)
            elif None in ids or not row[0] or row[0][-1].isspace():
                done.append(self._whole([text])[0])
            else:
                done.append(head + " " + " ".join(ids))
        return done

    def decode(self, ids: str) -> bytes:
        """The bytes of a text's ids."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids.split(" ")]) if ids else b""


def chunks(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with their texts, cut so that one slice holds about `CHUNK` code points."""
    column = batch.column(batch.schema.get_field_index(text))
    begin, size, held = 0, 0, []
    for i, value in enumerate(column):
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= CHUNK:
            yield batch.slice(begin, i + 1 - begin), held
            begin, size, held = i + 1, 0, []
    if held:
        yield batch.slice(begin), held


def _runner(docs: DataFrame, ranks_path: str, pattern: str, cut: bool):
    ranks = read_ranks(ranks_path)
    order = tuple(sorted(ranks.values()))
    # Bounded by the vocabulary, about 2 MB.
    model = docs.sparkSession.sparkContext.broadcast((model_bytes(ranks), order))
    return lambda: Codec(*model.value, pattern, cut)


def encoded(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    cut: bool = True,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """(doc_id, ids array<int>, decoded string): each text's token ids, and the text they stand for.

    Each match of `pattern` is encoded by itself. For `cut` see `Codec`. A NULL or empty text has no ids and decodes to an
    empty text; repeated rows and rows with a NULL key are encoded each for itself; other columns are
    left out, whatever their names; a table without rows gives an empty table.
    """
    ready = _runner(docs, ranks_path, pattern, cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ready()
        for batch in batches:
            for part, texts in chunks(batch, "t"):
                ids = coder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([[int(i) for i in row.split()] for row in ids], pa.list_(pa.int32())),
                        pa.array([coder.decode(row).decode() for row in ids], pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )

    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    schema = StructType(
        [
            StructField("doc_id", picked.schema["k"].dataType),
            StructField("ids", ArrayType(IntegerType(), False)),
            StructField("decoded", StringType()),
        ]
    )
    return picked.mapInArrow(run, schema)


def digest(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    cut: bool = True,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Number of ids, and SHA-256 of the ids as text and of the bytes they decode to.

    As `encoded`, without building the ids of a whole table as arrays.
    """
    ready = _runner(docs, ranks_path, pattern, cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ready()
        for batch in batches:
            for part, texts in chunks(batch, "t"):
                ids = coder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([row.count(" ") + 1 if row else 0 for row in ids], pa.int64()),
                        pa.array([hashlib.sha256(row.encode()).hexdigest() for row in ids]),
                        pa.array([hashlib.sha256(coder.decode(row)).hexdigest() for row in ids]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    picked = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    schema = StructType(
        [
            StructField("doc_id", picked.schema["k"].dataType),
            StructField("n_tokens", LongType()),
            StructField("ids_sha256", StringType()),
            StructField("decoded_sha256", StringType()),
        ]
    )
    return picked.mapInArrow(run, schema)

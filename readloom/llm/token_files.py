"""Token-id output: flat unsigned integer files with 64-bit document offsets, memory-mapped.

A part holds a range of documents in ascending doc_id order: ``part-N.bin`` has their ids one
after another, little-endian, in the narrowest of 16 and 32 bits that the vocabulary fits; and
``part-N.idx`` has, per document, its doc_id and the 64-bit offset of its first id in the part, as
pairs of 64-bit integers.  A part's base (ids of all parts before it) is a prefix sum over the
parts' totals; only those totals, one row a part, come to the driver.  Each file is written under a
name of its task attempt and renamed when whole, so a lost or repeated task leaves a right file.

Texts are moved once, by range of doc_id, before they are encoded; ids go straight to their file.

Edge cases: a null or empty text has the end id alone; rows of one doc_id stand together, ordered
by text; null ids come first; an empty table gives no parts and an empty result; extra columns are
not read; many rows of one doc_id are parted by the first 16 characters of their texts, so only rows that
agree in those too must share a part.  A text that holds the end marker's own string, or white space around a space (where a
cut is not certain), is encoded by the library whole instead of by pieces.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.bpe import PLAIN_WORD, as_letters, load_tokenizer, tokenizer_path
from readloom.llm.scratch import Scratch, shuffles_removed
from readloom.llm.tables import ids_and_texts, table, text_bytes
from readloom.llm.words import row_slices

#: Texts of a part, in bytes.
PART_BYTES = 24 << 20
KEPT_PIECES, KEPT_STEMS = 600_000, 300_000

#: The Unicode white space besides the plain space and the line feed.
OTHER_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0                　"
_uncertain = re.compile(r"\s (?:\s|$)")


class _Pieces(dict):
    """Ids of pieces, without the space that each begins with; made when first asked for."""

    def __init__(self, encoder: PieceEncoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        if m := PLAIN_WORD.fullmatch(piece):  # a space, letters, then signs: the library's merges do
            stem, signs = m.groups()
            got = self.encoder.stem(" " + stem) + (self.encoder.stem(signs) if signs else b"")
        elif "\n" in piece and all(lines := [PLAIN_WORD.fullmatch(x) for x in piece.split("\n")]):
            # A line feed between two words is a pre-token.
            stems = self.encoder.stem
            each = [stems((" " if i == 0 else "") + m[1]) + (stems(m[2]) if m[2] else b"") for i, m in enumerate(lines)]
            got = stems("\n").join(each)
        else:
            got = self.encoder.packed([" " + piece])[0]
        if len(piece) <= 64:
            self[piece] = got
        return got


class PieceEncoder:
    """Byte-level BPE by pieces that begin at a space; a piece met before isn't encoded again."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.model = self.tokenizer.model
        self.stems: dict[str, bytes] = {}
        self.pieces = _Pieces(self)

    def certain(self, text: str) -> bool:
        """Whether a pre-token begins at every space, so that pieces encode as in the whole text."""
        if any([s in text for s in self.specials]):
            return False
        if "  " in text or "\n " in text or text.endswith(" ") or any([c in text for c in OTHER_SPACE]):
            return not _uncertain.search(text)
        return True

    def packed(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def stem(self, text: str) -> bytes:
        got = self.stems.get(text)
        if got is None:
            got = array(self.code, [t.id for t in self.model.tokenize(as_letters(text))]).tobytes()
            if len(text) <= 64:
                if len(self.stems) >= KEPT_STEMS:
                    self.stems.clear()
                self.stems[text] = got
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        known, out, whole = self.pieces, [], []
        if len(known) > KEPT_PIECES:
            known.clear()
        for text in texts:
            if text and not self.certain(text):
                out.append(None)
                whole.append(text)
                continue
            first, *rest = text.split(" ")
            parts = [known[p] for p in rest]
            if first:
                parts.insert(0, self.packed([first])[0])
            out.append(b"".join(parts))
        wholes = iter(self.packed(whole) if whole else [])
        return [next(wholes) if x is None else x for x in out]


@lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """The process's own: what a task has encoded serves the worker's later tasks."""
    return PieceEncoder(path)


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_parts(docs: DataFrame, folder: str, path: str, end_id: int | None = None, part_bytes: int = PART_BYTES) -> list[dict]:
    """Writes the files and returns the manifest: a dict per part, in order, with its base."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, name = context.partitionId(), f"part-{context.partitionId():06d}"
        store = encoder = None
        ids, offsets, total = [], [], 0
        for batch in batches:
            for piece in row_slices(batch, "text"):
                if encoder is None:
                    encoder = piece_encoder(path)
                    store, root = _filesystem(folder)
                    attempt = f"{root}/.{name}-{context.taskAttemptId()}"
                    out = store.open_output_stream(f"{attempt}.bin")
                    end = b"" if end_id is None else np.array([end_id], encoder.dtype).tobytes()
                    width = encoder.dtype.itemsize
                rows = encoder.encode([x or "" for x in piece.column("text").to_pylist()])
                out.write(b"".join([x for r in rows for x in (r, end)]))
                sizes = np.array([len(r) + len(end) for r in rows], np.int64) // width
                offsets.append(np.concatenate([[0], np.cumsum(sizes)[:-1]]) + total)
                ids.append(piece.column("doc_id"))
                total += int(sizes.sum())
        if encoder is None:
            return
        out.close()
        ids = pa.concat_arrays(ids)
        index = np.stack([ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), np.concatenate(offsets)], 1).astype("<i8")
        with store.open_output_stream(f"{attempt}.idx") as f:
            f.write(index.tobytes())
        for kind in ("bin", "idx"):
            store.move(f"{attempt}.{kind}", f"{root}/{name}.{kind}")
        yield pa.RecordBatch.from_pylist([{"part": part, "name": name, "n_docs": len(index), "n_ids": total, "width": width}])

    pairs = ids_and_texts(docs)
    parts = max(1, -(-text_bytes(pairs) // part_bytes))
    _, root = _filesystem(folder)
    _filesystem(folder)[0].create_dir(root, recursive=True)
    # The start of the text parts rows of one id that are many; it sorts as whole texts do.
    dealt = pairs.repartitionByRange(parts, "doc_id", F.substring("text", 1, 16)).sortWithinPartitions("doc_id", "text")
    with shuffles_removed(docs.sparkSession):
        written = dealt.mapInArrow(work, "part long, name string, n_docs long, n_ids long, width long").collect()  # a row for each part
    base, manifest = 0, []
    for r in sorted(written, key=lambda r: r["part"]):
        manifest.append(r.asDict() | {"base": base})
        base += r["n_ids"]
    return manifest


def open_part(folder: str, name: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, index) of a part: memory-mapped where the shared folder is mounted, else read."""
    store, root = _filesystem(folder)
    if store.type_name == "local":
        ids = np.memmap(f"{root}/{name}.bin", f"<u{width}", "r") if store.get_file_info(f"{root}/{name}.bin").size else np.zeros(0, f"<u{width}")
    else:
        ids = np.frombuffer(store.open_input_file(f"{root}/{name}.bin").read(), f"<u{width}")
    index = np.frombuffer(store.open_input_file(f"{root}/{name}.idx").read(), "<i8").reshape(-1, 2)
    return ids, index


def read_parts(spark: SparkSession, folder: str, manifest: list[dict]) -> DataFrame:
    """From the files: doc_id, start (ids before it in all parts), n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, index = open_part(folder, r["name"], r["width"])
                bounds = np.append(index[:, 1], len(ids))
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                doc = pa.array(index[:, 0], mask=index[:, 0] == np.iinfo(np.int64).min)
                yield pa.RecordBatch.from_arrays([doc, pa.array(index[:, 1] + r["base"]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    if not manifest:
        return spark.createDataFrame([], schema)
    rows = spark.createDataFrame(manifest, "part long, name string, n_docs long, n_ids long, width long, base long")
    return rows.repartitionById(len(manifest), F.col("part").cast("int")).mapInArrow(work, schema)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "tokens")
    folder = f"{scratch.path}/files"
    manifest = write_parts(table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return read_parts(spark, folder, manifest)


QUERIES = {"op8_token_files": op8_token_files}

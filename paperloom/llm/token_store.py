"""Token-id output in binary shards with a shared zstandard dictionary (operator 1).

``write_token_store`` encodes every whole text, sorts documents by id over range partitions and writes one shard for
each partition straight from the task that encoded it. A shard is two files:

``NNNNN.ids``
    magic ``PLTOK001``, the SHA-256 of the dictionary (32 bytes), then one zstandard frame for each document. A frame
    holds the ids as little-endian unsigned integers of ``width`` bytes (2 when the vocabulary fits, else 4).
``NNNNN.idx``
    magic ``PLTIX001``, the same SHA-256, ``width`` and the number of documents (both u64), then columns: document ids
    (i64), whether the id is null (u8), first id of each document within the shard (u64, n + 1) and offset of each
    frame in the ``.ids`` file (u64, n + 1).

``dictionary.zdict`` is trained on the serialized ids of a bounded sample of documents: rows drawn evenly over the whole
table, at most ``DICT_SAMPLE`` of them, whatever their ids, and ``DICT_SAMPLE_IDS`` ids of each. It only affects the
compression ratio: every document is encoded whole, whatever the sample holds. One short document is read with two ranged
reads.

Defined results: null text is empty (the document is its end id alone); null ids sort first; rows with equal ids stay,
ordered by the hash of their text; an empty table gives a store without shards; other columns are ignored. Tasks write
under a name of their own and rename at the end, so repeated or speculative attempts leave the same shard.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import common
from paperloom.llm.tokens import encoded, encoder

DICT_SAMPLE = 512
DICT_SAMPLE_IDS = 32_768
DICT_BYTES = 65_536
SEED = 40_961
LEVEL = 3
IDS_MAGIC, IDX_MAGIC = b"PLTOK001", b"PLTIX001"


def width_of(path: str) -> int:
    return 2 if encoder(path).size <= 1 << 16 else 4


def narrow(raw: bytes, width: int) -> bytes:
    import numpy as np

    return raw if width == 4 else np.frombuffer(raw, "<u4").astype("<u2").tobytes()


def widen(raw: bytes, width: int) -> bytes:
    import numpy as np

    return raw if width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A zstandard dictionary; where the samples are too few to train on, they are themselves the dictionary."""
    import zstandard

    samples = [s for s in samples if s]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def codecs(dictionary: bytes):
    import zstandard

    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d), zstandard.ZstdDecompressor(dict_data=d)


def _rows(batches, *names):
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names))


def dictionary_rows(docs: DataFrame) -> DataFrame:
    """About ``DICT_SAMPLE`` rows of ``docs``: each row is drawn for itself, so equal or null ids don't come together."""
    n = docs.count()
    return docs if n <= DICT_SAMPLE else docs.sample(DICT_SAMPLE / n, seed=SEED)


def write_token_store(spark: SparkSession, docs: DataFrame, out: str, tokenizer: str, end_id: int, shards: int | None = None) -> None:
    """Encode ``docs`` (doc_id, text) into a store at ``out``; see the module's docstring for the format."""
    import pyarrow as pa
    from pyarrow import fs as pafs

    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), common.text_of(docs).alias("text"))
    n = shards or common.partitions(spark)
    width = width_of(tokenizer)

    def sample(batches):
        for _, raw in encoded(tokenizer, batches, end_id):
            yield pa.record_batch({"raw": [narrow(raw[: 4 * DICT_SAMPLE_IDS], width)]})

    taken = dictionary_rows(docs).mapInArrow(common.task(sample), "raw binary").orderBy("raw").limit(DICT_SAMPLE).collect()
    dictionary = train_dictionary([bytes(r[0]) for r in taken])
    fs, base = common.open_fs(out)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/dictionary.zdict") as f:
        f.write(dictionary)
    digest = hashlib.sha256(dictionary).digest()

    def write(batches):
        import numpy as np
        from pyspark import TaskContext

        shard, mark = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, base = common.open_fs(out)
        press = codecs(dictionary)[0]
        ids, nulls, firsts, offsets = [], [], [0], [40]
        own = f"{base}/{shard:05d}.ids"
        with fs.open_output_stream(f"{own}.{mark}") as f:
            f.write(IDS_MAGIC + digest)
            for doc_id, raw in encoded(tokenizer, batches, end_id):
                frame = press.compress(narrow(raw, width))
                f.write(frame)
                ids.append(doc_id or 0)
                nulls.append(doc_id is None)
                firsts.append(firsts[-1] + len(raw) // 4)
                offsets.append(offsets[-1] + len(frame))
        if not ids:
            fs.delete_file(f"{own}.{mark}")
            return
        index = own[:-4] + ".idx"
        with fs.open_output_stream(f"{index}.{mark}") as f:
            f.write(IDX_MAGIC + digest + struct.pack("<QQ", width, len(ids)))
            for values, kind in ((ids, "<i8"), (nulls, "u1"), (firsts, "<u8"), (offsets, "<u8")):
                f.write(np.array(values, dtype=kind).tobytes())
        fs.move(f"{own}.{mark}", own)
        fs.move(f"{index}.{mark}", index)
        yield pa.record_batch({"shard": [shard], "n_docs": [len(ids)], "n_tokens": [firsts[-1]]}, schema=pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    dealt = docs.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    dealt.mapInArrow(common.task(write), "shard int, n_docs long, n_tokens long").write.mode("overwrite").parquet(f"{out}/manifest")
    for left in fs.get_file_info(pafs.FileSelector(base)):
        if left.is_file and left.base_name.count(".") > 1:  # of attempts that were lost
            fs.delete_file(left.path)


def read_index(fs, base: str, shard: int) -> tuple[bytes, int, list]:
    """(dictionary hash, width, [document ids, null flags, firsts, offsets]) of a shard."""
    import numpy as np

    with fs.open_input_stream(f"{base}/{shard:05d}.idx") as f:
        raw = f.read()
    assert raw[:8] == IDX_MAGIC, "not an index of a token store"
    width, n = struct.unpack_from("<QQ", raw, 40)
    at, out = 56, []
    for kind, count in (("<i8", n), ("u1", n), ("<u8", n + 1), ("<u8", n + 1)):
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    return raw[8:40], width, out


def read_document(out: str, shard: int, doc_id: int) -> list[int]:
    """The ids of one document: the index, then one ranged read of its frame."""
    import numpy as np

    fs, base = common.open_fs(out)
    with fs.open_input_stream(f"{base}/dictionary.zdict") as f:
        dictionary = f.read()
    digest, width, (ids, _, _, offsets) = read_index(fs, base, shard)
    assert digest == hashlib.sha256(dictionary).digest(), "the shard was written with another dictionary"
    at = int(np.flatnonzero(ids == doc_id)[0])
    with fs.open_input_file(f"{base}/{shard:05d}.ids") as f:
        frame = f.read_at(int(offsets[at + 1] - offsets[at]), int(offsets[at]))
    return np.frombuffer(widen(codecs(dictionary)[1].decompress(frame), width), "<u4").tolist()


def read_token_store(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of a store; ids are little-endian unsigned 32-bit integers.

    The manifest (one row for each shard) gives each shard its global start; shards are read in parallel.
    """
    import pyarrow as pa

    rows = sorted(spark.read.parquet(f"{out}/manifest").select("shard", "n_tokens").collect())
    starts, total = [], 0
    for shard, n_tokens in rows:
        starts.append((shard, total))
        total += n_tokens
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches):
        fs, base = common.open_fs(out)
        with fs.open_input_stream(f"{base}/dictionary.zdict") as f:
            dictionary = f.read()
        unpress, own = codecs(dictionary)[1], hashlib.sha256(dictionary).digest()
        for shard, start in _rows(batches, "shard", "start"):
            digest, width, (ids, nulls, firsts, offsets) = read_index(fs, base, shard)
            assert digest == own, "the shard was written with another dictionary"
            with fs.open_input_file(f"{base}/{shard:05d}.ids") as f:
                for i in range(0, len(ids), 500):
                    j = min(i + 500, len(ids))
                    raw = f.read_at(int(offsets[j] - offsets[i]), int(offsets[i]))
                    edges = (offsets[i : j + 1] - offsets[i]).tolist()
                    docs = [widen(unpress.decompress(raw[a:b]), width) for a, b in zip(edges, edges[1:])]
                    keys = [None if null else k for k, null in zip(ids[i:j].tolist(), nulls[i:j])]
                    yield pa.record_batch([keys, (firsts[i:j].astype("i8") + start).tolist(), [len(d) // 4 for d in docs], docs], schema=schema)

    table = spark.createDataFrame(starts, "shard int, start long")
    return table.repartition(max(1, len(starts)), "shard").mapInArrow(common.task(read), "doc_id long, start long, n_tokens long, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every document of ``documents`` through the store and back."""
    import public_tokenizers

    out = common.work_dir(spark, "token-store")
    write_token_store(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), out, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return read_token_store(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

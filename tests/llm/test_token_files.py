"""Token files: a round trip against the plain library, seeks, checksums and the file format itself."""

import glob
import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trialbook.llm import QUERIES, token_files
from trialbook.session import new_path

from test_small_tables import CLASH, ROWS, SCHEMA

NAME = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [*ROWS, (17, "a <|endoftext|> b", None, None), (18, "x" * 200_000, None, None)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in [*CLASH, "o0", "o1", "ids", "file"]}).repartition(5)


def ids_of(plain, text):
    return np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


def written(spark, docs, **options):
    folder = new_path(spark, "test-token-files")
    token_files.write(docs, folder, NAME, **options)
    return folder


@pytest.mark.parametrize("options", [{}, {"file_bytes": 200, "frame_bytes": 64}])
def test_round_trip(spark, docs, plain, options):
    folder = written(spark, docs, **options)
    got = token_files.fetch(token_files.index(spark, folder), folder).collect()
    want = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in want]
    at = 0
    for r in got:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in got), key=key) == sorted(((r["doc_id"], ids_of(plain, r["text"]).tobytes()) for r in want), key=key)


def test_a_choice_reads_only_its_frames(spark, docs, plain, tmp_path):
    folder = written(spark, docs, frame_bytes=1000)
    chosen = token_files.index(spark, folder, [10, 4, 999])
    assert sorted(r["doc_id"] for r in token_files.fetch(chosen, folder).collect()) == [4, 10]
    all_of = token_files.index(spark, folder)
    long = all_of.filter("doc_id = 10").head()
    assert len(long["sizes"]) > 1  # a long document takes several frames
    # Frames of other documents may be damaged: they are not read.
    for file in glob.glob(f"{folder.removeprefix('file:')}/data/*"):
        content = bytearray(open(file, "rb").read())
        for r in all_of.filter(F.col("file") == file.rsplit("/", 1)[1]).collect():
            if r["doc_id"] not in (4, 10):
                content[r["at"] : r["at"] + sum(r["sizes"])] = bytes(sum(r["sizes"]))
        open(file, "wb").write(content)
    got = {r["doc_id"]: bytes(r["ids"]) for r in token_files.fetch(chosen, folder).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert got == {i: ids_of(plain, texts[i]).tobytes() for i in (4, 10)}
    with pytest.raises(Exception):
        token_files.fetch(all_of, folder).collect()


def test_files_are_plain_zstandard_with_a_seek_table(spark, docs):
    folder = written(spark, docs)
    total = 0
    for file in glob.glob(f"{folder.removeprefix('file:')}/data/*"):
        content = open(file, "rb").read()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True).read()
        frames, width, _, _, tokens = token_files.tables_of(io.BytesIO(content), len(content))
        assert width == 2 and len(whole) == 2 * tokens.sum() == frames[:, 1].sum()
        total += len(tokens)
    assert total == docs.count()


def test_a_wrong_checksum_is_an_error():
    frame = zstandard.ZstdCompressor().compress(b"abcd")
    good = token_files._checksum(b"abcd")
    assert token_files._content([frame], [good], 2) == np.frombuffer(b"abcd", "<u2").astype("<u4").tobytes()
    with pytest.raises(ValueError):
        token_files._content([frame], [good ^ 1], 2)


def test_an_empty_table(spark, docs):
    folder = written(spark, docs.filter("false"))
    assert token_files.fetch(token_files.index(spark, folder), folder).collect() == []
    assert token_files.fetch(token_files.index(spark, folder, [1]), folder).collect() == []


def test_query(spark, plain):
    folder = "/root/testdata/sf0.001"
    want, at = [], 0
    for r in spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect():
        ids = ids_of(plain, r["text"])
        want.append((r["doc_id"], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in QUERIES["op11_token_files"](spark, folder).collect()) == want

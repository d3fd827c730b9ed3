"""Token files of repeated ids over several blocks."""
import public_tokenizers
from pyspark.sql import functions as F

from scorecraft.llm.token_files import read_blocks, read_token_files, write_token_files


def test_start_ascends_with_repeated_ids(spark, tmp_path):
    pairs = spark.sparkContext.parallelize([(k, f"text {k}") for k in (5, 9, 5, 5)], 2)  # a block each
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "files"))
    rows = sorted(read_token_files(spark, str(tmp_path / "files")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [5, 5, 5, 9]


def test_files_in_name_order_hold_ascending_ids(spark, tmp_path):
    """Partitions whose ranges of ids do not overlap but stand in another order."""
    folder = tmp_path / "files"
    docs = spark.range(0, 1000, 1, 3).select(((F.col("id") + 340) % 1000).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), str(folder))
    ids = [i for f in sorted((folder / "blocks").glob("part-*")) for _, found, _, _ in read_blocks(f.read_bytes()) for i in found.to_pylist()]
    assert ids == list(range(1000))
    rows = sorted(read_token_files(spark, str(folder)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == ids

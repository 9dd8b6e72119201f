"""Block-compressed files: splits, order, columns, regions; the writer."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from skein.sources import blocks, text


def calls(n, samples=3, chroms=("1", "2", "X"), seed=1):
    rnd = random.Random(seed)
    head = ["##fileformat=VCFv4.2", "##reference=GRCh38", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t" + "\t".join(f"S{k}" for k in range(samples))]
    body = []
    for c in chroms:
        for pos in sorted(rnd.sample(range(1, 40 * n), n)):
            ref, alt = rnd.sample("ACGT", 2)
            body.append("\t".join([c, str(pos), rnd.choice([".", f"rs{pos}"]), ref, alt, ".", "PASS", "x" * rnd.randint(0, 40), "GT", *(rnd.choice(["0/0", "0/1", "1/1", "./."]) for _ in range(samples))]))
    return head + body


def packed(lines, size=300, end="\n", last=True):
    data = end.join(lines).encode() + (end.encode() if last else b"")
    return b"".join(blocks.block(data[k : k + size]) for k in range(0, len(data), size)) + blocks.END


def got(df):
    return [r.value for r in df.orderBy("file", "line_no").collect()]


@pytest.mark.parametrize("size", [40, 5000])
@pytest.mark.parametrize("split", [300, 1 << 26])
def test_every_line_once_in_order(spark, tmp_path, size, split):
    lines = calls(60)
    (tmp_path / "a.vcf.gz").write_bytes(packed(lines, size))
    (tmp_path / "b.vcf.gz").write_bytes(packed(lines[:5] + [""] + lines[5:9] + ["z" * 9000], size, last=False))
    df = blocks.block_lines(spark, str(tmp_path), split)
    assert got(df) == lines + lines[:5] + [""] + lines[5:9] + ["z" * 9000]
    expected = sum(-(-f.stat().st_size // split) for f in tmp_path.iterdir())
    assert df.rdd.getNumPartitions() == expected
    assert df.select("file", "line_no").distinct().count() == df.count()


def test_gzip_itself_reads_what_is_written_here(tmp_path):
    lines = calls(20)
    assert gzip.decompress(packed(lines, 77)).decode().split("\n")[:-1] == lines
    noise = random.Random(4).randbytes(blocks.BLOCK)
    assert gzip.decompress(blocks.block(noise)) == noise and blocks.block_size(blocks.block(noise)) == len(blocks.block(noise)) <= 1 << 16


def test_borders_of_lines_and_blocks_meet(spark, tmp_path):
    """Lines that end with a block, and lines over many blocks, at every split size."""
    lines = ["a" * 9, "b" * 9, "c" * 95, "", "d" * 9]
    data = packed(lines, 10)
    (tmp_path / "x.gz").write_bytes(data)
    for split in range(20, len(data) + 20, 7):
        found = [(n, v) for k in range(0, len(data), split) for n, v in blocks.lines_in(str(tmp_path / "x.gz"), k, min(k + split, len(data)))]
        assert [v.decode() for _, v in found] == lines and [n for n, _ in found] == sorted({n for n, _ in found})


def test_plain_files_ends_and_errors(spark, tmp_path):
    lines = calls(5)
    (tmp_path / "plain.vcf").write_text("\n".join(lines))
    (tmp_path / "member.vcf.gz").write_bytes(gzip.compress("\r\n".join(lines).encode()))
    (tmp_path / "empty.gz").write_bytes(blocks.END)
    (tmp_path / "none.txt").write_bytes(b"")
    assert got(blocks.block_lines(spark, str(tmp_path / "*.vcf"))) == lines
    assert got(blocks.block_lines(spark, f"file://{tmp_path}/member.vcf.gz")) == lines
    assert got(blocks.block_lines(spark, str(tmp_path / "empty.gz"))) == got(blocks.block_lines(spark, str(tmp_path / "none.txt"))) == []
    (tmp_path / "cut.gz").write_bytes(packed(lines)[:-40])
    with pytest.raises(Exception, match="cut off|no block begins"):
        got(blocks.block_lines(spark, str(tmp_path / "cut.gz")))
    with pytest.raises(Exception, match="missing"):
        got(blocks.block_lines(spark, str(tmp_path / "missing.gz")))


def test_fields_keep_one_sample(spark, tmp_path):
    (tmp_path / "a.vcf.gz").write_bytes(packed(calls(40, samples=50), 400))
    whole = text.parse_vcf(text.lines(spark, str(tmp_path / "a.vcf.gz")), 7)
    pruned = text.parse_vcf(blocks.block_lines(spark, str(tmp_path / "a.vcf.gz"), 1000, fields=[*range(9), 16]), 0)
    assert sorted(map(str, whole.drop("line_no").collect())) == sorted(map(str, pruned.drop("line_no").collect())) and whole.count() == 120
    assert text.read_calls(spark, str(tmp_path / "a.vcf.gz"), 7, split_bytes=1000).drop("line_no").exceptAll(whole.drop("line_no")).isEmpty()


def test_regions(spark, tmp_path):
    lines = calls(80)
    path = tmp_path / "a.vcf.gz"
    path.write_bytes(packed(lines, 200))
    for regions, wanted in ((["2:100-900"], lambda c, p: c == "2" and 100 <= p <= 900), (["X"], lambda c, p: c == "X"), (["1:5", "X:3,000-"], lambda c, p: (c == "1" and p == 5) or (c == "X" and p >= 3000)), (["9"], lambda c, p: False)):
        want = [x for x in lines if x.startswith("#") or wanted(x.split("\t")[0], int(x.split("\t")[1]))]
        for in_order in (False, True):
            assert got(blocks.block_lines(spark, str(path), 500, regions=regions, in_order=in_order)) == want
    pruned = blocks.block_lines(spark, str(path), 500, regions=["2:100-900"], in_order=True)
    assert pruned.rdd.getNumPartitions() < blocks.block_lines(spark, str(path), 500, regions=["2:100-900"]).rdd.getNumPartitions() / 3


def test_writer(spark, tmp_path):
    lines = [f"line {k}\t{'é' * (k % 50)}" for k in range(20_000)]
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(lines)], "k int, value string").repartitionByRange(3, "k").sortWithinPartitions("k")
    blocks.write_blocks(frame, f"{tmp_path}/out")
    files = sorted((tmp_path / "out").iterdir())
    assert len(files) == 3 and all(f.name.startswith("part-") for f in files)
    assert [x for f in files for x in gzip.decompress(f.read_bytes()).decode().split("\n")[:-1]] == lines
    assert got(blocks.block_lines(spark, f"{tmp_path}/out", 5000)) == lines
    with pytest.raises(Exception, match="no lines for you"):
        blocks.write_blocks(frame.select(F.when(F.col("k") == 19_999, F.raise_error(F.lit("no lines for you"))).otherwise(F.col("value")).alias("value")), f"{tmp_path}/broken")
    assert not list((tmp_path / "broken").glob("part-*"))

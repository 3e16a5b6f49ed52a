"""Genomes read in byte ranges against whole records."""

import gzip
import random

import pytest

from tailmap.operators import sites
from tailmap.sources import genome, text


def fasta(rng):
    lines = []
    for i in range(12):
        lines.append(f">c{i} some words|x" if i % 3 else f">c{i}")
        width = rng.choice([7, 60, 10_000])
        letters = "".join(rng.choices("ACGTNacgt", k=rng.choice([0, 1, 59, 60, 61, 700, 2500])))
        lines += [letters[k : k + width] for k in range(0, len(letters), width)]
        lines += [""] * rng.randint(0, 1)
    return "\n".join(lines)


@pytest.mark.parametrize("step,size,overlap,fragment", [(1 << 20, 500, 40, 1 << 16), (97, 64, 16, 50), (13, 700, 100, 9), (1, 256, 3, 1000)])
def test_ranges_give_what_records_give(spark, tmp_path, step, size, overlap, fragment):
    made = fasta(random.Random(step))
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "a.fa").write_text(made if step > 1 else made[:400])
    (tmp_path / "g" / "b.fa.gz").write_bytes(gzip.compress(b">z1\nACGT\nAC\n>z2 y\n" + b"G" * 900 + b"\n"))
    (tmp_path / "g" / "c.fa").write_text("")
    want = sites.chunked(text.read_fasta(spark, str(tmp_path / "g")).withColumnRenamed("id", "chr"), size=size, overlap=overlap)
    got = genome.read_genome(spark, str(tmp_path / "g"), size=size, overlap=overlap, step=step, fragment=fragment)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

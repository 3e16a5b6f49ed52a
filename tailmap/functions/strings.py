"""Functions over alignment strings and adapters that built-in expressions cannot express, as Arrow UDFs over whole batches.

Those on alignment strings wrap a small function of one value, or share a template; adapters are aligned in arrays over a batch.  Null arguments give
null.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_STEP, _MD = re.compile(r"(\d+)([A-Z=])"), re.compile(r"(\d+)|\^([A-Za-z]+)|([A-Za-z])")
_COMPLEMENT = str.maketrans("ACGTacgt", "TGCAtgca")


def _udf(one: Callable, kind: str, *columns: Column) -> Column:
    def rows(*arrays: pa.Array) -> pa.Array:
        return pa.array([None if None in r else one(*r) for r in zip(*(a.to_pylist() for a in arrays), strict=True)], pa.string())

    return F.arrow_udf(rows, kind)(*columns)


def edit_string(cigar: str, md: str, seq: str) -> str:
    """Runs of matches as numbers, ``Mxy`` for y read in place of x, ``Ix`` for an insertion, ``Dx`` for a deletion.

    Soft-clipped ends are left out, as are introns.
    """
    reference: list[str | None] = []  # of every reference position: its letter where the read has another or none
    for run, deleted, letter in _MD.findall(md):
        reference += [None] * int(run) if run else list(deleted or letter)
    out, at_ref, at_read, run = [], 0, 0, 0

    def flush() -> None:
        nonlocal run
        if run:
            out.append(str(run))
            run = 0

    for n, step in ((int(n), s) for n, s in _STEP.findall(cigar)):
        if step == "S":
            at_read += n
        elif step == "I":
            flush()
            out += [f"I{c}" for c in seq[at_read : at_read + n]]
            at_read += n
        elif step == "D":
            flush()
            out += [f"D{c}" for c in reference[at_ref : at_ref + n]]
            at_ref += n
        elif step == "M":
            for i in range(n):
                if (c := reference[at_ref + i]) is None:
                    run += 1
                else:
                    flush()
                    out.append(f"M{c}{seq[at_read + i]}")
            at_ref, at_read = at_ref + n, at_read + n
    flush()
    return "".join(out)


_STEPS, _MISMATCHES, _RUNS = re.compile(r"([0-9]+)([SIDM])"), re.compile(r"[0-9]+|\^[A-Za-z]+|[A-Za-z]"), re.compile("(=+)")


def _walked(cigar: str, md: str, letters: list[str]) -> str:
    """The steps of the CIGAR followed along the mismatch string and the read, runs of matches counted at the end.

    The mismatch string is a line with a letter for each position of the reference, = where the read has the same.
    """
    line = "".join(["=" * (int(t) if int(t) < 1 << 31 else 0) if t[0].isdigit() else t.lstrip("^") for t in _MISMATCHES.findall(md)])
    out, at_ref, at_read = [], 0, 0
    for n, step in ((int(n), s) for n, s in _STEPS.findall(cigar)):
        here, read = line[at_ref : at_ref + n], letters[at_read : at_read + n]
        if step == "M":
            # A mismatch behind the read's end is left out, but for a step's first, which has no letter of the read.
            out += [r if r == "=" else f"M{r}{''.join(read[k : k + 1])}" for k, r in enumerate(here) if r == "=" or k == 0 or k < len(read)]
        elif step in "ID":
            out += [step + c for c in (read if step == "I" else here)]
        at_ref += n * (step in "MD")
        at_read += n * (step != "D")
    return "".join([str(len(t)) if t[:1] == "=" else t for t in _RUNS.split("".join(out))])


@functools.lru_cache(maxsize=4096)
def _template(cigar: str, md: str, length: int) -> tuple[str, tuple[int, ...]]:
    """What ``_walked`` makes of any read of so many letters, with %s where it has a letter of the read, and which these are."""
    parts = _walked(cigar, md, [f"\0{k}\0" for k in range(length)]).split("\0")
    return "%s".join(parts[::2]), tuple(map(int, parts[1::2]))


def walked_all(cigars: list[str], mds: list[str], seqs: list[str]) -> list[str]:
    """``_walked`` of each; those of equal CIGAR, mismatches and length share a template."""
    out = []
    for cigar, md, seq in zip(cigars, mds, seqs, strict=True):
        if "=" in seq:  # counts as a match, so it is no letter like others
            out.append(_walked(cigar, md, list(seq)))
        else:
            shape, places = _template(cigar, md, len(seq))
            out.append(shape % tuple([seq[k] for k in places]))
    return out


def mmid(cigar: Column, md: Column, seq: Column) -> Column:
    """``edit_string`` of every row, a batch at a time; null where a part is missing."""
    return _batch_udf(walked_all, cigar, md, seq)


def spliced_cigar(cigar: str, strand: str, fragments: list[int]) -> str:
    """A transcript alignment's CIGAR on the genome: reversed on the minus strand, with introns between the fragments.

    fragments: in genomic order, exon overlap, intron, exon overlap, and so on.
    """
    steps = [(int(n), s) for n, s in _STEP.findall(cigar)]
    if strand == "-":
        steps.reverse()
    exons, introns = list(fragments[0::2]), list(fragments[1::2])
    out: list[tuple[int, str]] = []
    left = exons.pop(0) if introns else None
    for n, step in steps:
        if step not in "MD":
            out.append((n, step))
            continue
        while introns and n >= left:
            out.append((left, step))
            n -= left
            out.append((introns.pop(0), "N"))
            left = exons.pop(0)
        if n:
            out.append((n, step))
            if introns:
                left -= n
    return "".join(f"{n}{s}" for n, s in out if n)


def genomic_cigar(cigar: Column, strand: Column, fragments: Column) -> Column:
    """``spliced_cigar`` of every row."""
    return _udf(spliced_cigar, "string", cigar, strand, fragments)


def reversed_md(md: str) -> str:
    """The mismatch string of the other strand."""
    return "".join(x if x.isdigit() else ("^" if x[0] == "^" else "") + x.lstrip("^").translate(_COMPLEMENT)[::-1] for x in reversed(re.findall(r"\d+|\^?[A-Za-z]+", md)))


def reverse_md(md: Column) -> Column:
    """``reversed_md`` of every row."""
    return _udf(reversed_md, "string", md)


#: A cell of the alignment table is one number: its cost, 2 bits of which way it came from (kept at zero), its matches and where
#: the stretch of the read begins.  Adapters of up to so many letters take cells of 32 bits, with 5 of them for the matches.
_BEGIN, _SHORT = 20, 30
#: Letters of a block of sequences, and sequences of it.
_CELLS, _BLOCK = 1 << 22, 1 << 14


def adapter_places(seqs: list[str], adapter: str, error_rate: float, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """For each sequence the matches of the best place of a 3' adapter (-1: none) and where it begins.

    The adapter, or what of it is before the sequence's end, is aligned to a stretch of the sequence with substitutions,
    insertions and deletions, one for every whole 1 / ``error_rate`` letters of the adapter's part at most; N in the adapter is
    any letter.  The most matches count, then the fewest errors, then the stretch that ends first.  Where letters are equal they
    are aligned; else a substitution is preferred to a letter of the adapter that is left out, and that to one of the sequence.

    All sequences go through the table together, column by column; those that have ended, as the longest come first, drop out.
    """
    matches, begins = np.full(len(seqs), -1, dtype=np.int64), np.zeros(len(seqs), dtype=np.int64)
    if not adapter:
        return matches, begins
    lengths = np.array([len(s) for s in seqs], dtype=np.int64)
    longest_first = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(seqs):
        width = max(1, int(lengths[longest_first[at]]))
        if width >= 1 << _BEGIN:
            raise ValueError("a read is longer than a million letters")
        part = longest_first[at : at + max(1, min(_BLOCK, _CELLS // width))]
        matches[part], begins[part] = _places([seqs[i] for i in part], lengths[part], adapter, error_rate, overlap)
        at += len(part)
    return matches, begins


def _places(seqs: list[str], lengths: np.ndarray, adapter: str, error_rate: float, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """``adapter_places`` of sequences by falling length."""
    m, n, width = len(adapter), len(seqs), int(lengths[0])
    letters = np.frombuffer("".join(s.ljust(width, "\0") for s in seqs).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(n, width).T.copy()
    kind, bits = (np.uint32, 5) if m <= _SHORT else (np.uint64, 20)
    way = _BEGIN + bits
    at_cost = way + 2
    one, match, by_adapter, by_read, kept = (kind(x) for x in (1 << at_cost, 1 << _BEGIN, 1 << way, 2 << way, np.iinfo(kind).max ^ (3 << way)))
    limits = [kind((min(int(error_rate * i), m) + 1) << at_cost) for i in range(m + 1)]
    cells = [np.full(n, i << at_cost, dtype=kind) for i in range(m + 1)]
    spare, before, top, chosen = (np.empty(n, dtype=kind) for _ in range(4))
    best, begins = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)
    ended = np.searchsorted(-lengths, -np.arange(width + 1), side="left")  # how many are longer than so many letters

    def offer(cell: np.ndarray, i: int, lo: int) -> None:
        """Take this cell of the sequences from lo on where it is better than what they have."""
        few = np.flatnonzero(cell < limits[i])
        if not len(few):
            return
        said, at = cell[few].astype(np.int64), few + lo
        score = (((said >> _BEGIN) & ((1 << bits) - 1)) << _BEGIN) + m - (said >> at_cost)
        better = score > best[at]
        best[at[better]], begins[at[better]] = score[better], (said & ((1 << _BEGIN) - 1))[better]

    for j in range(width):
        live = int(ended[j])
        equal = {c: np.negative((letters[j, :live] == ord(c)).astype(kind)) for c in set(adapter)}
        before[:live], top[:live] = j, j + 1
        diagonal, above, out = before, top[:live], chosen[:live]
        for i, c in enumerate(adapter, 1):
            left, new, d = cells[i][:live], spare[:live], diagonal[:live]
            if c == "N":
                np.add(d, match, out=new)
            else:
                # The way with the least cost, of equal ones the first: marks below the cost tell them apart, and go.
                np.bitwise_or(above, by_adapter, out=new)
                np.minimum(new, d, out=new)
                np.bitwise_or(left, by_read, out=out)
                np.minimum(new, out, out=new)
                np.bitwise_and(new, kept, out=new)
                np.add(new, one, out=new)
                # Where letters are equal, the diagonal.
                np.add(d, match, out=out)
                np.bitwise_xor(out, new, out=out)
                np.bitwise_and(out, equal[c], out=out)
                np.bitwise_xor(new, out, out=new)
            diagonal, cells[i], spare, above = cells[i], spare, diagonal, new
        before = diagonal
        if m >= overlap:
            offer(above, m, 0)
        still = int(ended[j + 1])
        if still < live:
            for i in range(overlap, m + 1):
                offer(cells[i][still:live], i, still)
    return np.where(best < 0, -1, best >> _BEGIN), begins


def _by_adapter(seqs: list[str], adapters: list[str], error_rate: float, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """``adapter_places`` of sequences that each have an adapter of their own; there are few different ones."""
    matches, begins, rows = np.full(len(seqs), -1, dtype=np.int64), np.zeros(len(seqs), dtype=np.int64), {}
    for k, a in enumerate(adapters):
        rows.setdefault(a, []).append(k)
    for a, places in rows.items():
        matches[places], begins[places] = adapter_places([seqs[k] for k in places], a, error_rate, overlap)
    return matches, begins


def _backwards(texts: list[str]) -> list[str]:
    return [t[::-1] for t in texts]


def trimmed_3p(seqs: list[str], adapters: list[str], error_rate: float = 0.1, overlap: int = 3) -> list[str]:
    """Each sequence before its 3' adapter, or all of it."""
    matches, begins = _by_adapter(seqs, adapters, error_rate, overlap)
    return [s if m < 0 else s[:b] for s, m, b in zip(seqs, matches.tolist(), begins.tolist(), strict=True)]


def trimmed_5p(seqs: list[str], adapters: list[str], error_rate: float = 0.1, overlap: int = 3) -> list[str]:
    """Each sequence after its 5' adapter, which may be cut off by the start."""
    return _backwards(trimmed_3p(_backwards(seqs), _backwards(adapters), error_rate, overlap))


def trimmed_best(seqs: list[str], threes: list[str], fives: list[str], error_rate: float = 0.1, overlap: int = 3) -> list[str]:
    """Each without that one of two adapters which matches more, the 3' one of equals."""
    right, cut = _by_adapter(seqs, threes, error_rate, overlap)
    left, kept = _by_adapter(_backwards(seqs), _backwards(fives), error_rate, overlap)
    found = zip(seqs, right.tolist(), cut.tolist(), left.tolist(), kept.tolist(), strict=True)
    return [s[len(s) - k :] if f > t else s if t < 0 else s[:c] for s, t, c, f, k in found]


def _batch_udf(trim: Callable[..., list[str]], *columns: Column | str, **options: float) -> Column:
    """``trim`` of whole batches; rows with a null go round it."""

    def rows(*arrays: pa.Array) -> pa.Array:
        values = [a.to_pylist() for a in arrays]
        whole = [k for k, r in enumerate(zip(*values, strict=True)) if None not in r]
        out: list[str | None] = [None] * len(arrays[0])
        for k, kept in zip(whole, trim(*[[v[k] for k in whole] for v in values], **options), strict=True):
            out[k] = kept
        return pa.array(out, pa.string())

    return F.arrow_udf(rows, "string")(*[F.lit(c) if isinstance(c, str) else c for c in columns])


def trim_adapters(seq: Column, three: Column | str, five: Column | str, *, error_rate: float = 0.1, overlap: int = 3) -> Column:
    """``trimmed_best`` of every row."""
    return _batch_udf(trimmed_best, seq, three, five, error_rate=error_rate, overlap=overlap)


def trim_adapter_3p(seq: Column, adapter: Column | str, *, error_rate: float = 0.1, overlap: int = 3) -> Column:
    """``trimmed_3p`` of every row."""
    return _batch_udf(trimmed_3p, seq, adapter, error_rate=error_rate, overlap=overlap)


def trim_adapter_5p(seq: Column, adapter: Column | str, *, error_rate: float = 0.1, overlap: int = 3) -> Column:
    """``trimmed_5p`` of every row."""
    return _batch_udf(trimmed_5p, seq, adapter, error_rate=error_rate, overlap=overlap)


def trim_polya(seq: Column, *, length: int = 14, error_rate: float = 0.1) -> Column:
    """Without the poly(A) tail at the end, however short."""
    return trim_adapter_3p(seq, "A" * length, error_rate=error_rate, overlap=1)

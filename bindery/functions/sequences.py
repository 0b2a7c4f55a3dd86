"""Column expressions over DNA strings and read descriptions. All stay inside Spark's expression engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = ("A", "C", "G", "T")


def revcomp(s: Column) -> Column:
    """Reverse complement; null for letters outside ACGTN-."""
    return F.when(s.rlike("^[ACGTN-]*$"), F.translate(F.reverse(s), "ACGT", "TGCA"))


def count_char(s: Column, *letters: str) -> Column:
    out = F.lit(0)
    for c in letters:
        out = out + F.length(s) - F.length(F.replace(s, F.lit(c), F.lit("")))
    return out.cast("long")


def strip_markup(bases: Column) -> Column:
    """Pileup bases without read starts (with their quality), read ends, placeholders, and indels with their letters."""
    plain = F.regexp_replace(bases, r"\^.|[$*]", "")
    # Each piece after an indel sign begins with its length, which tells how many letters are not bases here.
    parts = F.split(plain, "[+-](?=[0-9])")
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda p: F.substring(p, F.length(F.regexp_extract(p, "^[0-9]+", 0)) + F.regexp_extract(p, "^[0-9]+", 0).cast("int") + 1, F.length(p)))
    return F.concat(parts[0], F.concat_ws("", rest))


def base_counts(bases: Column, forward: bool) -> dict[str, Column]:
    """coverage, one count of each letter, and mutations, of one strand of a pileup column. Markup letters count."""
    match, letters = (".", BASES) if forward else (",", [b.lower() for b in BASES])
    counts = {b: count_char(bases, x) for b, x in zip(BASES, letters, strict=True)}
    mutations = counts["A"] + counts["C"] + counts["G"] + counts["T"]
    return {"coverage": count_char(bases, match) + mutations, **counts, "mutations": mutations}


def kmers(s: Column, k: int) -> Column:
    """All overlapping k-mers in order; an empty array for short strings. One pass: a look-ahead at each place."""
    return F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def chunks(s: Column, width: int, more: int = 0) -> Column:
    """Pieces of `width` letters in order, each with up to `more` letters of what follows, in one pass; an empty array
    for the empty string. What spans at most more + 1 letters lies whole in the piece that its first letter is in."""
    pieces = F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{1,{width + more}}})).{{1,{width}}}"), F.lit(1))
    return F.when(F.length(s) > width, pieces).when(s != "", F.array(s)).when(s == "", F.array().cast("array<string>"))


def occurrences(s: Column, sub: str) -> Column:
    """0-based starts of all, also overlapping, occurrences."""
    return F.array_compact(F.transform(kmers(s, len(sub)), lambda x, i: F.when(x == sub, i.cast("long"))))


def md_mismatches(md: Column) -> Column:
    """array<struct<ref, pos>>: mismatched reference bases of an MD tag with their 0-based read positions."""
    parts = F.regexp_extract_all(md, F.lit(r"[0-9]+|\^[A-Z]+|[A-Z]"), F.lit(0))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<ref:string,pos:bigint>>").alias("out"))

    def step(a: Column, p: Column) -> Column:
        number, deletion = p.rlike("^[0-9]"), p.startswith("^")
        width = F.when(number, p.try_cast("long")).when(deletion, F.lit(0)).otherwise(F.lit(1)).cast("long")
        hit = F.array(F.struct(p.alias("ref"), a["at"].alias("pos")))
        return F.struct((a["at"] + width).alias("at"), F.when(number | deletion, a["out"]).otherwise(F.concat(a["out"], hit)).alias("out"))

    return F.aggregate(parts, start, step, lambda a: a["out"])


def mapped_span(cigar: Column, length: Column) -> tuple[Column, Column]:
    """(first, one past the last) read position that is not soft-clipped at an edge of a CIGAR string."""
    left = F.coalesce(F.regexp_extract(cigar, r"^(\d+)S", 1).try_cast("int"), F.lit(0))
    right = F.coalesce(F.regexp_extract(cigar, r"[A-Z](\d+)S$", 1).try_cast("int"), F.lit(0))
    return left, length - right


def clip_adapters(seq: Column, qual: Column, five: str, three: str, barcode5: int = 0, barcode3: int = 0) -> tuple[Column, Column]:
    """Reads between the last 5' adapter and the first 3' adapter after it, less barcodes, and qualities cut alike."""
    last = F.locate(five[::-1], F.reverse(seq))
    begin = F.when((F.lit(five) != "") & (last > 0), F.length(seq) - last + 1).otherwise(0) + barcode5
    hit = F.locate(three, seq, 1) if three else F.lit(0)
    end = F.when(hit > 0, hit - 1).otherwise(F.length(seq)) - barcode3
    size = F.greatest(end - begin, F.lit(0))
    return F.substring(seq, begin + 1, size), F.substring(qual, begin + 1, size)


def remove_five(seq: Column, adapter: str, seed: int, mode: str = "seeded") -> Column:
    """Read after a 5' adapter: `strict` (whole adapter at the start), `seeded` (longest adapter suffix of at
    least `seed` letters at the start), `anywhere` (after the last occurrence of the longest such suffix)."""
    sizes = [len(adapter)] if mode == "strict" else range(len(adapter), max(seed, 1) - 1, -1)
    tries = []
    for n in sizes:
        suffix = adapter[len(adapter) - n :]
        if mode == "anywhere":
            last = F.locate(suffix[::-1], F.reverse(seq))
            tries.append(F.when(last > 0, F.right(seq, last - 1)))
        else:
            tries.append(F.when(seq.startswith(suffix), F.substring(seq, n + 1, 1 << 30)))
    return F.coalesce(*tries, seq)


def pow_ratio(k: Column, n: Column, a: Column, b: Column) -> Column:
    """log of the beta-binomial probability of k out of n, by sums of logarithms in place of gamma functions."""

    def log_rising(x: Column, m: Column) -> Column:
        return F.when(m > 0, F.aggregate(F.sequence(F.lit(0).cast("long"), F.greatest(m, F.lit(1)).cast("long") - 1), F.lit(0.0), lambda s, i: s + F.log(x + i))).otherwise(F.lit(0.0))

    one = F.lit(1.0)
    choose = log_rising(one, n) - log_rising(one, k) - log_rising(one, n - k)
    return choose + log_rising(a, k) + log_rising(b, n - k) - log_rising(a + b, n)


def beta_binomial(k: Column, n: Column, a: Column, b: Column) -> Column:
    return F.exp(pow_ratio(k, n, a, b))


def binomial(k: Column, n: Column, p: Column) -> Column:
    def log_rising(m: Column) -> Column:
        return F.when(m > 0, F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(m, F.lit(1)).cast("long")), F.lit(0.0), lambda s, i: s + F.log(i.cast("double")))).otherwise(F.lit(0.0))

    return F.exp(log_rising(n) - log_rising(k) - log_rising(n - k)) * F.pow(p, k) * F.pow(1 - p, n - k)


def mixture(k: Column, n: Column, r: float, rho: float, a: float, b: float) -> Column:
    """Background of conversions: binomial noise with weight r, beta-binomial for the rest."""
    return r * binomial(k, n, F.lit(rho)) + (1 - r) * beta_binomial(k, n, F.lit(a), F.lit(b))

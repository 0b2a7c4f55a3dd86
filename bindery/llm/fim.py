"""Fill-in-the-middle transformation by one Aho-Corasick scan of each text.

A unit is a run of ASCII letters or one other code point. The text is first mapped to one ASCII character for
each code point (a letter, a space for any other, and the characters of the sentinels as they are); one
automaton then finds every pair of neighbours of different class and every sentinel. Between two such events
lie letters, which are one unit, or other characters, which are one unit each, so the units before each
event follow by arithmetic, and a cut at any unit is found by a search in that short list. No list of units is made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.common import release, table

#: The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = set(PREFIX + SUFFIX + MIDDLE)
#: Rows of an Arrow batch that are handed back at a time.
ROWS = 512


def _letter(b: int) -> bool:
    return 65 <= b <= 90 or 97 <= b <= 122


#: UTF-8 bytes to classes; bytes that continue a code point are left out, so places are code points.
CLASS = bytes(b if chr(b) in MARKS and b < 128 else ord("a") if _letter(b) else ord(" ") for b in range(256))
CONTINUED = bytes(range(0x80, 0xC0))


@cache
def _automaton() -> ahocorasick.Automaton:
    """Value 0 where the class changes, 1 for a sentinel."""
    a = ahocorasick.Automaton()
    kinds = sorted(MARKS | {"a", " "})
    letters = [c for c in kinds if _letter(ord(c))]
    for x in letters:
        for y in kinds:
            if y not in letters:
                a.add_word(x + y, 0)
                a.add_word(y + x, 0)
    for s in (PREFIX, SUFFIX, MIDDLE):
        a.add_word(s, 1)
    a.make_automaton()
    return a


class Units:
    """The units of a text, known by the events alone."""

    def __init__(self, text: str):
        classes = text.encode("utf-8", "surrogatepass").translate(CLASS, CONTINUED).decode("ascii")
        events = np.fromiter(chain.from_iterable(_automaton().iter(classes)), np.int64).reshape(-1, 2)
        self.marked = bool(events[:, 1].any())
        self.bounds = np.concatenate([[0], events[events[:, 1] == 0, 0], [len(classes)]]) if classes else np.zeros(1, np.int64)
        sizes = np.diff(self.bounds)
        self.first = 0 if classes and _letter(ord(classes[0])) else 1  #: gaps of this remainder modulo 2 are letters
        self.before = np.zeros(len(sizes) + 1, np.int64)
        sizes[self.first :: 2] = 1
        np.cumsum(sizes, out=self.before[1:])
        self.n = int(self.before[-1])

    def place(self, units: int) -> int:
        """Code points before the end of the first `units` units."""
        if units == 0:
            return 0
        gap = int(np.searchsorted(self.before, units)) - 1
        return int(self.bounds[gap + 1]) if gap % 2 == self.first else int(self.bounds[gap]) + units - int(self.before[gap])


def transform(text: str, key: str, plain_from: int = 90, spm_below: int = 20) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars, output of one text; draws follow from the SHA-256 of `key`."""
    units = Units(text)
    h = np.frombuffer(hashlib.sha256(key.encode()).digest()[:16], ">u4").tolist()
    if not text or units.marked or h[2] % 100 >= plain_from:
        return units.n, "plain", None, None, text
    a, b = (units.place(k) for k in sorted((h[0] % (units.n + 1), h[1] % (units.n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_below:
        return units.n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return units.n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def _rows(seed: int, plain_from: int, spm_below: int):
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                ids = part.column(0).to_pylist()
                made = [transform(t or "", f"{seed}:{'' if i is None else i}", plain_from, spm_below) for i, t in zip(ids, part.column(1).to_pylist(), strict=True)]
                columns = [ids, *zip(*made, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output: one row for each row of `docs`.

    Two draws in 0..n, both by the SHA-256 of "seed:id", are the units before and after the middle. A null
    text counts as empty; empty texts, those that hold a sentinel, and the share above `plain_from` in a
    hundred stay plain, with null lengths. Of equal rows each is transformed alike; a null id draws as the
    empty string; an empty table gives no rows; other columns are not read. No shuffle: texts are
    transformed where they are read, whatever their length.
    """
    schema = "id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_rows(seed, plain_from, spm_below), schema).withColumnRenamed("id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The text that `output` was made of. A text with sentinels is plain, so each sentinel is found where it was put."""
    part = lambda a, b: F.substring_index(F.substring_index(output, b, 1), a, -1)
    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(part(PREFIX, SUFFIX), middle, part(SUFFIX, MIDDLE))
    spm = F.concat(part(PREFIX, MIDDLE), middle, part(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('1:' || cast(doc_id as varchar)) as h from documents),
k as (
  select doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') as u,
    cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
    cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from d),
f as (
  select *, len(u) as n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) as a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from k),
p as (
  select doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') as pre, coalesce(array_to_string(u[a + 1:b], ''), '') as mid,
    coalesce(array_to_string(u[b + 1:n], ''), '') as suf from f)
select doc_id, n, form, case when form <> 'plain' then length(pre) end as prefix_chars, case when form <> 'plain' then length(mid) end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(t) as restored_sha256
from p
"""

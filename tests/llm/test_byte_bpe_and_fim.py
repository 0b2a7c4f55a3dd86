import base64
import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from bindery.llm.byte_bpe import ByteBpe, encode
from bindery.llm.fim import Units, fill_in_middle, restore, transform
from cases import frame, texts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def mine():
    return ByteBpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text_as_the_library(mine, library, text):
    ids = mine.encode(text)
    assert ids == library.encode_ordinary(text) and mine.decode(ids) == text.encode()


def test_words_that_need_backtracking_and_long_ones(mine, library):
    r = random.Random(3)
    for alphabet in ("ab", "aeinrst", "thet ", "日本語の", "=-_", "0123", "éßü a"):
        for _ in range(400):
            s = "".join(r.choice(alphabet) for _ in range(r.randint(1, 24)))
            assert mine.encode(s) == library.encode_ordinary(s), s
    for s in ("a" * 50_000, "ab" * 20_000, "x \t\n" * 9_000, "word " * 120_000, "日本" * 9_000, "don't we'll I'd", "x\x1cz\x85q", "\U000323e7 a՘b"):
        assert mine.encode(s) == library.encode_ordinary(s), s[:20]


def test_a_vocabulary_without_merges_is_refused(tmp_path):
    lines = [(bytes([b]), b) for b in range(256)] + [(b"abc", 256)]
    path = tmp_path / "odd.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in lines))
    with pytest.raises(ValueError, match="no merges"):
        ByteBpe(str(path), public_tokenizers.PATTERN)


def test_encode(spark, library):
    rows = texts()
    got = encode(frame(spark, rows), RANKS, public_tokenizers.PATTERN, digests=True).collect()
    want = []
    for i, x in rows:
        ids = library.encode_ordinary(x or "")
        want.append((str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((x or "").encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    plain = {r.doc_id: r for r in encode(frame(spark, rows[:9]), RANKS, public_tokenizers.PATTERN).collect()}
    assert bytes(plain[0].decoded).decode() == rows[0][1] and plain[0].ids == library.encode_ordinary(rows[0][1])
    assert encode(spark.createDataFrame([], "doc_id bigint, text string"), RANKS, public_tokenizers.PATTERN).count() == 0


def brute(text, doc_id):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(units), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@settings(max_examples=400, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from("abPSM<> \n.é日"), st.characters()), max_size=40), key=st.integers(0, 99))
def test_transform_as_the_list_of_units(text, key):
    assert transform(text, f"1:{key}") == brute(text, key)
    units, at = re.findall("[A-Za-z]+|[^A-Za-z]", text), 0
    known = Units(text)
    for k, u in enumerate(units):
        assert known.place(k) == at
        at += len(u)


def test_fill_in_middle(spark):
    rows = [*texts(), (900, "has <P> inside"), (901, "a<" * 30), (902, "<<P"), (903, "P>M>" * 9), (904, "日" * 9000 + "x")]
    made = fill_in_middle(frame(spark, rows))
    got = made.select("*", restore(made.output, made.form).alias("back")).collect()
    assert sorted(map(str, [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got])) == sorted(map(str, [(i, *brute(t or "", i), t or "") for i, t in rows]))
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0

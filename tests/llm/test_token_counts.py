import random

import pytest

from spacetime.llm.token_counts import Counter, stable, token_counts, vocabulary_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def test_edge_rows(make_docs, library):
    long = "word " * 40_000
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "It's <|endoftext|> 12 naïve 中文!"), (None, "a b"), (4, "It's <|endoftext|> 12 naïve 中文!"), (2**60 + 1, "x"), (5, long), (6, "y" * 70_000)]
    got = token_counts(make_docs(rows)).collect()
    want = sorted((str(i), len((t or "").encode()), library(t or ""), library(t or "") > 2048) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_empty_table(make_docs):
    assert token_counts(make_docs([])).count() == 0


def test_spliced_counts_equal_the_library(library):
    r = random.Random(3)
    pieces = ["a", "'s", "é", "é"[1:], "́", " ", "\n", " ", "<|endoftext|>", "1", "!", "中", "ß", "İ", "👩", "x" * 40, "  ", "\t", "ſ"]
    c = Counter(vocabulary_path())
    for _ in range(400):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 120)))
        c.chunk, c.overlap = r.choice([(5, 1), (20, 4), (50, 16)])
        assert c.huge(text) == library(text)


def test_stable_needs_space_before_and_none_after():
    assert stable("a b", 2)
    assert not stable("a b", 1) and not stable("a  b", 2) and not stable("a b", 2) and not stable("ab", 0)


def test_a_vocabulary_with_spaces_in_tokens_encodes_whole_texts(make_docs):
    from tokenizers import Tokenizer

    path = vocabulary_path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rows = [(1, "one two  three\n\nfour"), (2, "x " * 300), (3, None)]
    got = {r.doc_id: r.n_tokens for r in token_counts(make_docs(rows), vocabulary=path, chunk_chars=50).collect()}
    assert got == {i: len(t.encode(x or "", add_special_tokens=False).ids) for i, x in rows}

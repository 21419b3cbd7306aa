import random

import pytest
import regex

from apronflow.llm import tokens

PATH = f"{tokens.FOLDER}/byte_bpe_50k.tiktoken"
PARTS = [" ", "  ", "\n", "\t", "a", "bc", "1", "23", "'s", "'", "'ll", "é", "漢", "́", "\x1c", " ", " ", "-", "!!", "_", "\r\n", "ß", "٣", "​", "<|endoftext|>", "。", "、", "ไ", "่", "の", "ア", "क", "ि", "я", "１", "！", "　", "…"]


def chunked(text, chunk, overlap):
    at = [0, *tokens.cuts(text, chunk, overlap), len(text)]
    return [x for i, j in zip(at, at[1:], strict=False) for x in tokens.encoding(PATH).encode_ordinary(text[i:j])]


def test_chunks_give_the_ids_of_the_whole():
    r = random.Random(5)
    for _ in range(4000):
        text = "".join(r.choice(PARTS) for _ in range(r.randint(20, 120)))
        assert chunked(text, r.choice([8, 16, 32]), r.choice([4, 8, 16])) == tokens.encoding(PATH).encode_ordinary(text)


def test_long_texts_with_and_without_boundaries():
    for text in ("x" * 60_000, " " * 60_000, "word " * 20_000, "f(a,b);" * 9_000, "漢字" * 20_000):
        assert tokens.encode([text], PATH)[0] == tokens.encoding(PATH).encode_ordinary(text)
    assert tokens.cuts("word " * 20_000) and not tokens.cuts("x" * 60_000)


@pytest.mark.parametrize("text", ["これは長い文章です。改行はなく、句読点だけがある。", "这是一段很长的文字，没有空格，只有标点。", "ภาษาไทยไม่มีช่องว่างระหว่างคำ", "यह एक लंबा पाठ है", "это длинный текст,без пробелов", "漢字１２３カナ"])
def test_long_texts_of_many_scripts_are_cut(text):
    long = text * (80_000 // len(text))
    assert len(tokens.cuts(long)) == (len(long) - 1) // tokens.CHUNK
    assert tokens.encode([long], PATH)[0] == tokens.encoding(PATH).encode_ordinary(long)


def test_agrees_with_the_published_json_vocabulary():
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(f"{tokens.FOLDER}/byte_bpe_50k.json")
    library.encode_special_tokens = True
    r = random.Random(6)
    texts = ["".join(r.choice(PARTS) for _ in range(60)) for _ in range(200)]
    assert tokens.encode(texts, PATH) == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_rows(spark):
    rows = [(1, "def f():\n    return 1\n", "x"), (2, "", "x"), (3, None, "x"), (None, "a b", "x"), (1, "def f():\n    return 1\n", "x"), (4, "ab " * 30_000, "x"), (5, " \n ", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = tokens.encoded(df)
    out = sorted(((r.doc_id, list(r.ids)) for r in got.collect()), key=str)
    assert len(out) == len(rows)
    assert all(x == [] for k, x in out if k in (2, 3))
    back = {r.doc_id: r.text for r in tokens.decoded(got).collect()}
    assert all(back[k] == (t or "") for k, t, _ in rows)
    assert tokens.encoded(df.limit(0)).count() == 0


def test_classes_are_what_they_say():
    for chars, kind in ((tokens.LETTERS, r"\p{L}"), (tokens.DIGITS, r"\p{N}"), (tokens.MARKS, r"[^\s\p{L}\p{N}]"), (tokens.BLANKS, r"\s")):
        every = [c for c in map(chr, range(0x10000)) if regex.fullmatch(f"[{chars}]", c)]
        assert every and all(regex.fullmatch(kind, c) for c in every)

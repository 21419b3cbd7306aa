import random

import numpy as np

from apronflow.llm import splitting, tokens

PATH = f"{tokens.FOLDER}/byte_bpe_50k.tiktoken"
CODE = ["import os", "def alpha(x):", "    return x + beta(x)", "class Shop:", "    price = 3", "for i in range(10):", "    print(i)", "", "", "# über 漢字 emoji 😀", "\tx = {1: 'a'}"]


def document(seed, lines):
    r = random.Random(seed)
    return "\n".join(r.choice(CODE) for _ in range(lines))


def check(rows, text, rule):
    ids = tokens.encode([text], PATH)[0]
    rows = sorted(rows, key=lambda r: r.piece)
    joined = []
    for k, r in enumerate(rows):
        assert r.tokens == len(r.ids) <= rule.limit
        assert list(r.ids) == ids[r.first_token : r.first_token + r.tokens]
        if k:
            before = rows[k - 1]
            assert list(r.ids[: rule.overlap]) == list(before.ids[-rule.overlap :])
        joined += r.ids[rule.overlap if k else 0 :]
        assert r.text in text and "�" not in r.text
    assert list(joined) == ids
    table = splitting.marks(PATH)
    for k, r in enumerate(rows[:-1]):
        lines = [i for i, x in enumerate(r.ids) if table[0][x] and i >= (rule.overlap if k else rule.overlap - 1)]
        assert not lines or table[0][r.ids[-1]]


def test_pieces(spark):
    rule = splitting.Split()
    texts = {1: document(1, 50), 2: document(2, 900), 3: "x" * 9000, 4: "漢😀" * 3000, 5: "", 6: None, 7: "\n" * 3000, 8: "a b c " * 2000, 9: "ok", 10: document(3, 4000), 11: "a = 1\n" * 130 + "x y " * 3000 + "\nb = 2" * 200, 12: "ab\n" + "x" * 9000}
    df = spark.createDataFrame([(k, t, 0) for k, t in texts.items()], "doc_id long, text string, piece int")
    got = splitting.pieces(df).collect()
    by = {k: [r for r in got if r.doc_id == k] for k in texts}
    assert not by[5] and not by[6]
    assert len(by[9]) == 1 and by[9][0].text == "ok"
    for k, t in texts.items():
        if t:
            check(by[k], t, rule)
    assert splitting.pieces(df.limit(0)).count() == 0
    assert len(by[10]) == max(r.piece for r in by[10]) + 1


def test_repeated_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a\n" * 600), (1, "hi"), (1, "hi")], "doc_id long, text string")
    got = splitting.pieces(df).collect()
    assert sum(r.doc_id == 1 for r in got) == 2 and sum(r.doc_id is None for r in got) > 2


def test_topic_change_is_the_cut():
    a, b = "apples pears plums cherries grow in orchards\n" * 40, "sockets bind listen accept packets over networks\n" * 60
    ids = np.asarray(tokens.encode([a + b], PATH)[0])
    border = len(tokens.encode([a], PATH)[0])
    at = splitting.split(ids, np.frombuffer((a + b).encode(), np.uint8), splitting.marks(PATH), splitting.Split(limit=border + 60, overlap=10))
    assert at[1] == border


def last_words(text):
    ids, raw = np.asarray(tokens.encode([text], PATH)[0]), np.frombuffer(text.encode(), np.uint8)
    offset = np.r_[0, np.cumsum(splitting.marks(PATH)[2][ids])]
    return [raw[: offset[k]].tobytes().decode() for k in splitting.split(ids, raw, splitting.marks(PATH), splitting.Split())[1:-1]]


def test_without_line_ends_sentences_then_blanks_then_words():
    told = last_words("The lights went out in the long hall. Nobody spoke for a while; then they all did! " * 60)
    assert told and all(t.endswith((".", ";", "!")) for t in told)
    told = last_words("これは長い文章です。改行はありません！" * 120)
    assert told and all(t.endswith(("。", "！")) for t in told)
    text = "alpha beta gamma delta " * 400
    assert all(text[len(t)] == " " or t.endswith(" ") for t in last_words(text))
    text = "alpha/beta/gamma(delta)" * 400
    assert all(not (t[-1].isalnum() and text[len(t)].isalnum()) for t in last_words(text))
    assert last_words("漢😀" * 3000)

"""Documents that every operator must handle."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "length int, `offset` string, task string, row int, score string, number int, "
          "__fingerprint string, __fp int, __root long, __component string, __spans string, "
          "__copy int, __up int, fingerprint int, fp string, root long, component_id string, spans int")
MORE = ("f", 1, 2, "c", "<spans>", 3, 4, 5, "p", 6, "d", 7)  # names that the operators use themselves
ODD_TEXTS = [
    None, "", " ", "\n", "a", "  two  spaces   three\n\n\nlines \t tab \n", "trail  ", "\x00nul \x00",
    "x\x1cy \x1d z", "nb sp   em    q", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>",
    "don't I'LL we've 12 345,6.. end...", "été ÉTÉ é İ ΣΑΣ straße ñandú", "日本語 テキスト 😀👍🏽",
    "A" * 3000, "word " * 5000, ("lorem ipsum dolor " * 40 + "\n") * 60,
]


def odd_rows():
    rows = [(i, t, None if i % 3 else "en", None, None, 7, "x", "t", 1, "s", None)
            for i, t in enumerate(ODD_TEXTS)]
    rows.append((None, "no id at all", None, None, None, None, None, None, None, None, None))
    rows += [rows[4], rows[15]]  # repeated rows
    rng = random.Random(5)
    words = [("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9)))) for _ in range(400)]
    for i in range(40):
        text = " ".join(rng.choices(words, k=rng.randint(1, 900)))
        rows.append((100 + i, text, "en", "s", len(text), 1, "", "", 2, "", 3))
    return [r + MORE for r in rows]


def odd_docs(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)

import re

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text):
    w = WORD.findall(lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def linked(a, b):
    k = len(a & b)
    return bool(k) and 100 * k >= 75 * (len(a) + len(b) - k)


#: Nulls, empty and blank texts, a repeated row, a very long line, odd white space and other scripts.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three four"), (6, "One two\x0bthree FOUR\rfive six"), (6, "One two\x0bthree FOUR\rfive six"),
    (7, "word " * 30_000), (8, "x" * 200_000), (9, "Größe ça va 漢字 😀 it's 'll 123 ...\n\n\nend  "), (10, "\n\n"), (None, "no id here at all"), (11, "a b c"),
]


def odd_docs(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string")

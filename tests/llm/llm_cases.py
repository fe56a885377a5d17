"""Rows and plain Python versions that the operators are compared with."""

import re
import zlib
from collections import Counter

import duckdb

FOLDER = "/root/testdata/sf0.001"

#: Texts that every text operator must take: nulls, empty, blank, ties, repeats, odd characters, one long word.
TEXTS = [
    None, "", " \t\n", "a", "The the THE the the the", "one two three four five six seven eight nine ten eleven",
    "one two three four five six seven eight nine ten eleven", "ÉCOLE ß 1²3 x\u0085y z \x1c!", "x" * 5000,
    "he'll they've <|endoftext|> a<|startoftext|>b", "z " * 3000,
]

ROWS = [*enumerate(TEXTS), (5, TEXTS[5]), (None, "null id"), (None, None), (-3, "minus")]


def rows(name, columns, folder=FOLDER):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{folder}/{name}.parquet'").fetchall()


def documents(folder=FOLDER):
    return rows("documents", "doc_id, text", folder)


def frame(spark, texts, extra=()):
    """doc_id and text, with extra columns whose names an operator may use itself."""
    schema = "doc_id long, text string" + "".join(f", {c} string" for c in extra)
    return spark.createDataFrame([(*row, *("x" for _ in extra)) for row in texts], schema)


def found(df, order=str):
    return sorted((tuple(r) for r in df.collect()), key=order)


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", fold(text))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(text))


def crc(doc_id):
    return zlib.crc32((str(doc_id) if doc_id is not None else "").encode())


def shingle_components(docs):
    """(doc_id, set size, component id) of every row."""
    sets = []
    for _, text in docs:
        w = spaced(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    having, parent = {}, list(range(len(docs)))
    for i, s in enumerate(sets):
        for g in s:
            having.setdefault(g, []).append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in having[g] if j < i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted(
        ((doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(docs)), key=str
    )


def benchmark_hits(docs, items):
    """(doc_id, words, hit words, sorted item ids as strings) of every row."""
    windows = {}
    for item, text in items:
        w = alnum(text)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, of = alnum(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if items_ := windows.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    of |= items_
        out.append((doc, len(w), len(hit), sorted(map(str, of))))
    return out

"""Odd documents and brute-force versions."""

from pyspark.sql import functions as F

#: Columns named like those that the operators use inside.
CLASHES = (
    "bucket key size shard slot kept node n spans score lang_pred blob path start component_id host lines passes order "
    "rank ends bins copies bytes text_key size_class kind kinds sources target need number head members vector block"
).split()


def documents(spark, rows, schema="doc_id long, text string, source string, lang string"):
    """Rows of documents beside columns whose names clash with inner ones."""
    width = len(schema.split(","))
    full = [tuple(r) + (None,) * (width - len(r)) for r in rows]
    df = spark.createDataFrame(full, schema).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHES if c not in df.columns})


def words(text):
    """Words between space and tab to carriage return, A to Z in lower case."""
    out, word = [], ""
    for c in text or "":
        if c in " \t\n\v\f\r":
            out.append(word)
            word = ""
        else:
            word += c.lower() if c.isascii() else c
    return [w for w in [*out, word] if w]


def shingles(text, k=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))}


def groups(texts, percent):
    """Smallest id that links reach, for (id, text) pairs."""
    sets = {i: shingles(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


def repeated_strings(texts, length):
    """Kept bytes of (id, text) pairs without strings that a smaller id holds."""
    first = {}
    for i, t in texts:
        b = (t or "").encode()
        for x in range(len(b) - length + 1):
            s = b[x : x + length]
            first[s] = min(first.get(s, i), i)
    kept = {}
    for i, t in texts:
        b = (t or "").encode()
        gone = set()
        for x in range(len(b) - length + 1):
            if first[b[x : x + length]] < i:
                gone.update(range(x, x + length))
        kept[i] = bytes(c for x, c in enumerate(b) if x not in gone)
    return kept

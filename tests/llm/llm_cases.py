"""Small inputs shared by the tests of the training-data operators."""

import os

import duckdb

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\f\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = ("The harbour was quiet in the morning and nobody had expected the small boat to return so early. "
         "Two men stood on the pier, talking about the weather while a third one mended his nets. "
         "When the bell of the old church rang they all looked up, but only the boy by the wall began to run. "
         "Later that day the council met to decide what should be done with the empty houses near the shore.")


def words(text):
    out, cur = [], []
    for ch in text or "":
        if ch in SPACE:
            if cur:
                out.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
    return out + (["".join(cur)] if cur else [])


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def edge_rows():
    """Null columns, empty and blank texts, repeated rows, ties, odd characters and a long text."""
    near = PROSE.replace("empty houses", "vacant houses")
    return [
        (1, PROSE, "en", "s1", 1), (2, PROSE, "en", "s1", 1), (2, PROSE, "en", "s1", 1), (3, near, "en", "s2", 1),
        (4, "", "en", "s1", 0), (5, None, None, None, None), (6, " \t\n ", "de", "s3", 4), (7, "one two three", "xx", "odd", 1),
        (8, "one two three", "fr", "", 1), (9, "naïve Ünïcode   text   Ⅷ 😀 words", "es", "s9", 1),
        (None, PROSE + " tail", "en", "s1", 1), (11, "mail a.b@example.org, +49 (30) 1234-5678, 10.0.0.255 4111 1111 1111 1111", "en", "s4", 1),
        (12, ("word " * 9 + "\n") * 400, "en", "s5", 1), (13, " ".join(f"w{i}" for i in range(20_000)), "en", "s1", 1),
        (14, "a line\n\na line\n \nb line\na line\n", "en", "s1", 1),
        (15, "<|endoftext|> and <|im_start|> inside", "en", "s1", 1),
    ]


def table_dir(spark, path, docs, **others):
    """Write tables into a folder that a query can read."""
    docs.write.parquet(os.path.join(path, "documents.parquet"))
    for name, df in others.items():
        df.write.parquet(os.path.join(path, f"{name}.parquet"))
    return str(path)


def oracle(sql, sf=SF, tables=("documents", "benchmark", "labels")):
    con = duckdb.connect()
    for t in tables:
        p = os.path.join(sf, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p if os.path.isfile(p) else p + '/*.parquet'}')")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(names)
    return sorted(repr(tuple(_plain(r[names.index(n)]) for n in order)) for r in cur.fetchall())


def collected(df):
    order = sorted(df.columns)
    return sorted(repr(tuple(_plain(r[n]) for n in order)) for r in df.collect())


def _plain(v):
    return round(v, 9) if isinstance(v, float) else v

"""MinHash near-duplicates, conversation repair and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import SCHEMA, SF, SPACE, edge_rows, lower_az, table_dir, words
from pyspark.sql import functions as F

from trellis.llm import conversation_repair, minhash_dedup, queries, spelling
from trellis.llm.common import store, table

Q, _ = queries.load()
TALK = "conv_id long, turn long, role string, text string"
CLASH = ("key", "rep", "n", "word", "form", "seg", "row", "copy", "digest", "a", "b", "component_id")


def clashing(df):
    """More columns, named like those the operators make on the way."""
    for c in CLASH:
        df = df.withColumn(c, F.lit("x"))
    return df


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def dirs(spark, tmp_path_factory):
    edge = table_dir(spark, tmp_path_factory.mktemp("edge3"), clashing(spark.createDataFrame(edge_rows() * 5, SCHEMA)),
                     conversations=clashing(spark.createDataFrame(talk_rows(), TALK)))
    empty = table_dir(spark, tmp_path_factory.mktemp("empty3"), spark.createDataFrame([], SCHEMA), conversations=spark.createDataFrame([], TALK))
    return {"given": SF, "edge": edge, "empty": empty}


@pytest.mark.parametrize("name", ["op11_minhash_dedup", "op12_conversation_repair", "op13_spelling_variants"])
def test_empty_tables(spark, dirs, name):
    assert Q[name](spark, dirs["empty"]).collect() == []


# -- 11 MinHash

def shingle_sets(docs, k=5):
    out = []
    for i, text in docs:
        w = words(lower_az(text))
        out.append((i, frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) or (frozenset([tuple(w)]) if w else frozenset())))
    return out


def linked_components(docs, percent):
    rows = shingle_sets(docs)
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    owners = defaultdict(set)
    for i, s in rows:
        if i is not None and s:
            owners[s].add(i)
    sets = list(owners)
    where = defaultdict(list)
    for k, s in enumerate(sets):
        for i in owners[s]:
            join(min(owners[s]), i)
        for j, both in Counter(j for x in s for j in where[x]).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                join(min(owners[s]), min(owners[sets[j]]))
        for x in s:
            where[x].append(k)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in rows), key=repr)


@pytest.mark.parametrize("which", ["given", "edge"])
def test_minhash_equals_all_pairs(spark, dirs, which):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, dirs[which], "documents").collect()]
    got = Q["op11_minhash_dedup"](spark, dirs[which])
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == linked_components(docs, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())


def test_minhash_families_around_the_threshold_in_small_blocks(spark, monkeypatch):
    """Families whose members are now above, now below the threshold; buckets of several blocks."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    rnd = random.Random(5)
    rows = []
    for family in range(10):
        base = [f"w{rnd.randrange(500)}" for _ in range(rnd.choice([7, 30, 120, 400]))]
        for m in range(40):
            text = list(base)
            for _ in range(rnd.randrange(max(2, len(text) // 50) + 1)):
                text[rnd.randrange(len(text))] = f"z{rnd.randrange(9999)}"
            rows.append((family * 100 + m, " ".join(text)))
    rnd.shuffle(rows)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == linked_components(rows, 85)


def test_an_id_with_two_texts_joins_both_families(spark):
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, one), (9, two), (7, one), (7, two), (8, None), (8, "")]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == linked_components(rows, 85)


def test_long_chain_has_one_component(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["comp"] for r in minhash_dedup.connected(edges).collect()} == {0}


# -- 12 conversations

def talk_rows():
    rnd = random.Random(3)
    rows = [(c or None, rnd.choice([t, t, t, None, 3]), rnd.choice(["user", "assistant", "system", "tool", "", None, "assistant"]),
             rnd.choice(["Hi.", "What", "  ", "", "No! ", None, "é😀?", "x.\n"])) for c in range(50) for t in range(rnd.randrange(14))]
    rows += [(1000, i // 2, rnd.choice(["user", "assistant", "system", "user", "assistant", "tool"]),
              f"t{rnd.randrange(800)}{rnd.choice(['.', '.', '', '!'])}") for i in range(900)]
    return rows + [(2000, None, "user", "same.")] * 200 + [(2001, 1, "user", "word " * 30_000)]


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if h:
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            out += [(c, t, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def repair_one(rows):
    """The plain way: least (cost, audit) from every row and state, strings compared whole."""
    tie = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2][:64], r[3][:64], tie(r)))
    turns = [r[1] for r in rows if r[1] is not None]
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    first = [r[2][:1] for r in rows]
    goes = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    fills = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(v):
        for _ in range(3):
            for q in v:
                c, a, o = v[fills[q]]
                v[q] = min(v[q], (c + 3, "I" + a, (name[fills[q]] + ":", *o)))
        return v

    best = inserted({q: (0, "", ()) if q in ("", "a") else (10**9, "", ()) for q in ("", "s", "u", "a")})
    for (_, _, role, text), fault, initial in reversed(list(zip(rows, faults, first))):
        now, late = {}, 3 * (fault == "t")
        for q in best:
            c, a, o = best[q]
            ways = [(c + 4, "D" + a, o)]
            if fault not in ("b", "d"):
                c, a, o = best[fills[q]]
                ways.append((c + 3 + late, "R" + a, (f"{name[fills[q]]}:{text}", *o)))
                if (q, initial) in goes:
                    c, a, o = best[goes[q, initial]]
                    ways.append((c + late, "K" + a, (f"{role}:{text}", *o)))
            now[q] = min(ways)
        best = inserted(now)
    cost, audit, out = best[""]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def repairs(rows):
    talks = {r[0]: [] for r in rows}
    for r in damage(rows):
        talks[r[0]].append(r)
    return sorted(((c, *repair_one(x)) for c, x in talks.items()), key=repr)


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("which", ["given", "edge"])
def test_repair_equals_the_plain_way(spark, dirs, which):
    rows = [tuple(r) for r in table(spark, dirs[which], "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(Q["op12_conversation_repair"](spark, dirs[which]), *COLUMNS) == repairs(rows)


@pytest.mark.parametrize("rows,size", [(37, 10**9), (10**9, 300), (1, 10**9)])
def test_repair_over_many_segments(spark, monkeypatch, rows, size):
    monkeypatch.setattr(conversation_repair, "SEGMENT_ROWS", rows)
    monkeypatch.setattr(conversation_repair, "SEGMENT_BYTES", size)
    got = conversation_repair.repair(spark.createDataFrame(talk_rows(), TALK))
    assert rows_of(got, *COLUMNS) == repairs(talk_rows())


def test_blocks_equal_single_steps():
    tables, rnd = conversation_repair.TABLES, random.Random(1)
    for n in (0, 1, 3, 4, 5, 8, 30):
        symbols = bytes(rnd.randrange(9) for _ in range(n))
        v = conversation_repair.END
        for s in reversed(symbols):
            v = conversation_repair.before(s, v)
        at, total = tables.back(symbols, 0)
        assert tuple(x + total for x in tables.vectors[at[0]]) == v
        m = conversation_repair.matrix(symbols)
        assert tuple(min(m[4 * q + to] + conversation_repair.END[to] for to in range(4)) for q in range(4)) == v


# -- 13 spelling

def variants(docs, damage_every=199):
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower_az(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage_every and h % damage_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                count[run] += 1
    n = {w: c for w, c in count.items() if c >= 5}
    near, holes = {w: set() for w in n}, defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i] + "*" + w[i + 1:]].add(w)
    for w in n:
        for i in range(len(w)):
            near[w] |= holes[w[:i] + "*" + w[i + 1:]] - {w}
            less = w[:i] + w[i + 1:]
            if less in n:
                near[w].add(less)
                near[less].add(w)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= 5 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root))
    return sorted(out, key=repr)


SPELLED = ("word", "n", "n_near", "form", "form_n", "root")


@pytest.mark.parametrize("which", ["given", "edge"])
def test_variants_equal_brute_force(spark, dirs, which):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, dirs[which], "documents").collect()]
    assert rows_of(Q["op13_spelling_variants"](spark, dirs[which]), *SPELLED) == variants(docs)


@pytest.mark.parametrize("cell,leaf", [(8, 2), (60, 3), (10**6, 32)])
def test_variants_over_many_cells(spark, monkeypatch, cell, leaf):
    """Few letters, so that vectors tie; words of 300 letters; ties of n; accents and upper case."""
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "SAMPLE", 50)
    monkeypatch.setattr(spelling, "LEAF", leaf)
    monkeypatch.setattr(spelling, "PAIR_BYTES", 500)
    rnd = random.Random(cell)
    base = ["".join(rnd.choice("aAbcéÉ×÷") for _ in range(rnd.choice([6, 7, 8]))) for _ in range(120)] + ["a" * 300, "a" * 301, "a" * 299 + "b"]
    rows = []
    for i in range(400):
        w = list(rnd.choice(base))
        if rnd.random() < 0.5:
            at = rnd.randrange(len(w))
            w[at:at + 1] = rnd.choice([[], ["b"], [w[at], "c"]])
        rows.append((i, (("".join(w) + "-") * rnd.choice([1, 5, 9, 40]))))
    got = spelling.group_variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, *SPELLED) == variants(rows, None)


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(30)], "word string, form string")
    assert {r["root"] for r in spelling.roots(forms).collect()} == {"w030"}


# -- 9 blocks of items

def test_many_blocks_of_items_with_one_id(spark, monkeypatch):
    """Items of one id, or none, spread over blocks; every block is held against every document."""
    from trellis.llm import decontaminate
    monkeypatch.setattr(decontaminate, "ITEMS_PER_BLOCK", 7)
    text = lambda i: " ".join(f"w{i}_{j}" for j in range(12))
    items = spark.createDataFrame([(None if i % 3 else 5, text(i)) for i in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"before {text(i)} after") for i in range(0, 80, 2)], "doc_id long, text string")
    assert len(decontaminate.item_blocks(items)) > 5
    got = Counter((r["doc_id"], r["item_id"]) for r in decontaminate.contained_items(docs, items).collect())
    assert got == Counter((i, None if i % 3 else 5) for i in range(0, 60, 2))
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()) == list(range(60, 80, 2))


# -- 8 posterior

def test_rule_posterior_equals_plain_em(spark):
    """Votes as the rules give them, estimated again in plain Python; the stage keeps the same documents."""
    import math

    from test_llm_operators import plain_em
    from trellis.llm import quality_rules

    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    votes = quality_rules.rule_votes()
    rated = quality_rules.text_figures(docs, "doc_id").select("doc_id", F.array(*votes.values()).alias("v")).collect()
    prior, w = plain_em(Counter(tuple(r["v"]) for r in rated), quality_rules.SHARE, (0.7, 0.3), (0.02, 0.4))
    odds = lambda v: prior + sum(a if x > 0 else b if x < 0 else 0 for x, (a, b) in zip(v, w))
    want = {r["doc_id"]: 1 / (1 + math.exp(-odds(r["v"]))) for r in rated}
    got = {r["doc_id"]: r for r in Q["op8_rule_votes"](spark, sf).collect()}
    assert all(abs(got[i]["p_good"] - p) < 2e-3 for i, p in want.items())
    assert all(got[i]["kept"] == (not got[i]["base_failed"] and p >= quality_rules.THRESHOLD) for i, p in want.items() if abs(p - 0.5) > 1e-2)
    kept = {r["doc_id"] for r in quality_rules.keep_good(docs).collect()}
    assert kept == {i for i, r in got.items() if r["kept"]}


# -- memory of a task

def test_scratch_is_written_in_small_row_groups(spark):
    """A task holds one row group in memory: sets of long texts do not fill it up to 128 MB."""
    import numpy as np
    import pyarrow.parquet as pq

    def sets(batches):
        import pyarrow as pa

        for b in batches:
            for n in b.column("id").to_pylist():
                items = np.random.default_rng(n).integers(0, 2**63, 125_000).tobytes()
                yield pa.RecordBatch.from_pydict({"doc_id": [n], "items": [items]})

    frame = store(spark.range(60).coalesce(1).mapInArrow(sets, "doc_id long, items binary"), "long-sets")
    groups = []
    for path in frame.inputFiles():
        meta = pq.ParquetFile(path.removeprefix("file://")).metadata
        groups += [meta.row_group(i).total_byte_size for i in range(meta.num_row_groups)]
    assert sum(groups) > 60_000_000 and max(groups) < 32_000_000
    got = frame.collect()
    assert len(got) == 60 and all(r["items"] == np.random.default_rng(r["doc_id"]).integers(0, 2**63, 125_000).tobytes() for r in got)


def test_parquet_is_read_in_small_batches_unless_the_session_says_otherwise(spark, tmp_path):
    name = "spark.sql.parquet.columnarReaderBatchSize"
    path = table_dir(spark, str(tmp_path), spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    before = spark.conf.get(name)
    try:
        for given, want in (("4096", "512"), ("1000", "1000")):
            spark.conf.set(name, given)
            table(spark, path, "documents")
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)

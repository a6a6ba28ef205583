"""The manifest, fill-in-middle and decontamination: against brute force and SQL, over odd, repeated and missing values."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import corpus_sql, decontamination, fill_in_middle, manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu"
TEXTS = [None, "", " \t\n", "a", "x <P> y", "Ünï Σς 𝔘😀 ‍", "𝔘" * 3000, "word " * 9000, f"Before {PASSAGE.upper()}, after", PASSAGE + " nu", PASSAGE[6:], "Short--ITEM; here", "short item short item", "ß\u0085é  x", "9 lives 9"]
ITEMS = [(1, PASSAGE), (2, "short item"), (3, None), (4, "  "), (5, PASSAGE + " and more words of another one"), (10, "ß\u0085é"), (None, "9 lives"), (2, "here"), (7, "item short"), (8, "a a a a a a a a a a a a")]


def odd(spark, extra=True):
    langs = ["en", None, "", "é", "z", "en"]
    made = [(i, t, langs[i % 6], [None, "s", "ß"][i % 3], None if i % 4 == 3 else i) for i, t in enumerate(TEXTS)]
    made += [(None, "no id", "en", "s", 5), (None, "no id", "en", "s", 5), (3, "a", "é", "s", 1), (3, "b", "é", None, 1), made[5], made[5], (7**12, "far", "alone", "s", 3), (-7, "below", "en", "s", 5)]
    frame = spark.createDataFrame(made, SCHEMA)
    return frame.withColumns({c: F.lit("clash") for c in ("leaf", "tree", "i", "n", "form", "output", "__hit", "path", "root")}) if extra else frame


def tables(spark, folder, docs, items=ITEMS):
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    return con


def given(spark, size):
    if size == "whole":
        return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    if size == "many":  # trees of many blocks and of single rows
        ids = spark.range(1500)
        lang = F.when(F.col("id") % 3 == 0, F.concat(F.lit("l"), (F.col("id") % 300).cast("string"))).otherwise("en")
        return ids.select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"), lang.alias("lang"), F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    return odd(spark).limit(0) if size == "empty" else odd(spark)


@pytest.mark.parametrize("size", ["odd", "empty", "whole", "many"])
@pytest.mark.parametrize("query", ["op11_merkle_manifest", "op12_fill_in_middle", "op13_decontamination"])
def test_queries_against_their_sql(spark, tmp_path, query, size):
    con = tables(spark, tmp_path, given(spark, size), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect() if size == "whole" else [] if size == "empty" else ITEMS)
    module = {"op11": manifest, "op12": fill_in_middle, "op13": decontamination}[query[:4]]
    got = getattr(module, query)(spark, str(tmp_path))
    want = con.execute(getattr(corpus_sql, f"{query[:4].upper()}_SQL"))
    assert sorted(c[0] for c in want.description) == sorted(got.columns)
    rows = got.select(*(c[0] for c in want.description)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want.fetchall(), key=str)
    if size == "odd":
        assert len(rows) == len(TEXTS) + 8


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][j : j + 2]) for j in range(0, len(out[-1]), 2)])
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 255, 256, 257, 600])
def test_proofs_against_a_plain_tree(spark, size):
    """A group of the size and one of three rows, with paths that lead from every leaf to the root and from no other leaf."""
    docs = spark.range(size + 3).select(F.col("id").alias("doc_id"), F.when(F.col("id") < size, "a").otherwise("b").alias("lang"))
    got = manifest.with_proofs(docs, {"leaf": manifest.leaf_hash({"doc_id": F.col("doc_id")})})
    rows = {r.doc_id: r for r in got.select("doc_id", F.hex("root").alias("root"), F.size("path").alias("n"), F.hex(manifest.folded(F.col("leaf"), F.col("path"))).alias("up"), manifest.proof_text(F.col("path")).alias("proof")).collect()}
    trees = {g: levels([H(f"{len(str(i))}:{i}") for i in ids]) for g, ids in (("a", range(size)), ("b", range(size, size + 3)))}
    top = levels([trees["a"][-1][0], trees["b"][-1][0]])
    for i, r in rows.items():
        g, at = ("a", i) if i < size else ("b", i - size)
        want = [level[(at >> s) ^ 1] for s, level in enumerate(trees[g][:-1]) if (at >> s) ^ 1 < len(level)] + [top[0][g == "a"]]
        assert r.root.lower() == r.up.lower() == top[-1][0] and r.proof == "".join(want) and r.n == len(trees[g])
    assert len(rows) == size + 3


def test_tampered_rows_fail(spark, tmp_path):
    tables(spark, tmp_path, odd(spark))
    for r in manifest.op11_merkle_manifest(spark, str(tmp_path)).join(odd(spark).groupBy("doc_id").agg(F.min("n_chars").alias("n")), "doc_id").collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0 or r.n is None)
    assert zlib.crc32(str(7).encode()) and any(zlib.crc32(str(i).encode()) % 7 == 0 for i in range(len(TEXTS)))


@pytest.mark.parametrize("spacing", [1, 3, 1000])
@pytest.mark.parametrize("unit", [None, r"\w+\s*", r".", "a|ab"])
def test_cuts_against_counting(spacing, unit):
    """Every cut of every text, by code points and by patterns, whatever the spacing of checkpoints."""
    rng = random.Random(2)
    texts = [*(t or "" for t in TEXTS if len(t or "") < 200), "".join(rng.choice("ab cé😀\n") for _ in range(150))]
    for text in texts:
        raw = text.encode()
        index = fill_in_middle.Index(raw, unit and re.compile(unit), spacing)
        ends = [m.end() for m in re.finditer(unit or "(?s).", text) if m[0]]
        assert (index.n, index.length) == (len(ends), len(text))
        for k in range(len(ends) + 1):
            points = len(text) if k == len(ends) else ends[k - 1] if k else 0
            assert index.cut(k) == (len(text[:points].encode()), points)


def test_checkpoints_of_a_long_text(monkeypatch):
    monkeypatch.setattr(fill_in_middle, "STEP", 1000)
    text = "aé😀" * 40000
    index = fill_in_middle.Index(text.encode())
    assert len(index.units) == -(-len(text) // fill_in_middle.SPACING) and index.n == len(text)
    for k in (1, 1023, 1024, 1025, 70000, len(text) - 1):
        assert index.cut(k) == (len(text[:k].encode()), k)


def test_outputs_give_their_texts_back(spark):
    docs = odd(spark)
    for unit in (None, r"\w+\W*"):
        made = fill_in_middle.fill_in_middle(docs, unit)
        assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        back = fill_in_middle.restored(made)
        assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    forms = fill_in_middle.fill_in_middle(spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a text of some words").alias("text"))).groupBy("form").count().collect()
    share = {r.form: r["count"] / 3000 for r in forms}
    assert abs(share["plain"] - 0.1) < 0.03 and abs(share["spm"] - 0.18) < 0.03


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_matching_lengths_against_brute_force():
    """The longest run that ends at each word, and the items that hold the hit windows, over words that repeat a lot."""
    rng = random.Random(5)
    for _ in range(60):
        items = [(str(k), [rng.choice(b"abc") for _ in range(rng.randint(0, 14))]) for k in range(rng.randint(1, 6))]
        document = [rng.choice(b"abc") for _ in range(60)]
        window = rng.randint(2, 6)
        block = decontamination.block_of([(n, [bytes([x]) for x in w]) for n, w in items], window)
        known = [block.numbers.get(bytes([w]), -1) for w in document]
        runs = {tuple(w[i:j]) for _, w in items for i in range(len(w)) for j in range(i, len(w) + 1)}
        if -1 not in known:
            for at, (_, n) in enumerate(block.automaton.matches(known), 1):
                assert n == max(k for k in range(at + 1) if tuple(document[at - k : at]) in runs)
        hit, owners = decontamination.np.zeros(60, bool), set()
        block.scan([bytes([w]) for w in document], hit, owners)
        want_hit, want_owners = set(), set()
        for name, w in items:
            k = min(window, len(w))
            for i in range(len(w) - k + 1 if k else 0):
                for at in range(60 - k + 1):
                    if document[at : at + k] == w[i : i + k]:
                        want_hit |= set(range(at, at + k))
                        want_owners.add(name)
        assert set(hit.nonzero()[0]) == want_hit and owners == want_owners


def test_blocks_and_rounds_find_what_one_automaton_finds(spark):
    docs, items = odd(spark, extra=False).drop("lang", "source", "n_chars"), spark.createDataFrame(ITEMS, "item_id long, text string")
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    one = decontamination.scan(docs, items, decontamination._digests, schema).collect()
    several = decontamination.scan(docs, items, decontamination._digests, schema, block_words=9, at_once=2).collect()
    assert sorted(map(str, one)) == sorted(map(str, several)) and sum(r.contaminated for r in one) == 7


def test_spans_and_documents_go(spark):
    docs = spark.createDataFrame([(1, f"Keep this. {PASSAGE.upper()}! And keep these five other words of it, and some more of them here.", "x"), (2, PASSAGE, "x"), (3, "clean text", "y"), (4, None, "z"), (5, "", "z")], "doc_id long, text string, further string")
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    got = {r.doc_id: r.text for r in decontamination.decontaminate(docs, items).collect()}
    assert got == {1: "Keep this. ! And keep these five other words of it, and some more of them here.", 3: "clean text", 4: None, 5: ""}
    assert set(decontamination.decontaminate(docs, items, longest=12).select("doc_id").toPandas().doc_id) == {3, 4, 5}
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0 and decontamination.decontaminate(docs, items.limit(0)).count() == 5

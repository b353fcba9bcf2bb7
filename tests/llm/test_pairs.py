"""Substring dedup, Jaccard join, decontamination and the pipeline."""

import hashlib
import random
import types
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from streamlens.llm import arrays, components, decontaminate, jaccard, substrings
from oracle_check import connect, spark_rows, sql_rows
from streamlens.llm.arrays import mix
from streamlens.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


# --- substrings ---------------------------------------------------------------


def plain_removal(rows, size=substrings.WINDOW):
    """Every window against all that start earlier, row by row."""
    least, seen = {}, defaultdict(set)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0]))
    words = [(rows[i][1] or "").encode().split() for i in range(len(rows))]
    for i in order:
        for s in range(len(words[i]) - size + 1):
            least.setdefault(tuple(words[i][s : s + size]), rows[i][0])
    out = []
    for i, (doc_id, _) in enumerate(rows):
        covered = [False] * len(words[i])
        for s in range(len(words[i]) - size + 1):
            window = tuple(words[i][s : s + size])
            if least[window] != doc_id or window in seen[i]:
                covered[s : s + size] = [True] * size
            seen[i].add(window)
        kept = b" ".join(w for w, c in zip(words[i], covered) if not c)
        out.append((doc_id, len(words[i]), sum(covered), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeated_rows(rng):
    passages = [[rng.choice("abcdefgh") + str(rng.randint(0, 9)) for _ in range(n)] for n in (19, 20, 21, 60, 200)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randint(0, 6)):
            if rng.random() < 0.5:
                p = rng.choice(passages)
                cut = rng.randint(0, len(p) // 2)
                words += p[cut : len(p) - rng.randint(0, len(p) // 3)]
            else:
                words += [rng.choice("xyz") * rng.randint(1, 3) for _ in range(rng.randint(1, 40))]
            if rng.random() < 0.2:
                words += ["run"] * rng.randint(1, 70)
            if rng.random() < 0.2:
                words += ["a", "b"] * rng.randint(1, 40)
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words)))
    return rows


@pytest.mark.parametrize("batch_words", [400_000, 500])
def test_removal_equals_brute_force(docs, monkeypatch, batch_words):
    monkeypatch.setattr(substrings, "BATCH_WORDS", batch_words)
    rows = repeated_rows(random.Random(5))
    rows += [(None, rows[40][1]), (7, rows[7][1]), (7, rows[40][1]), (500, None), (501, ""), (502, "few words")]
    rows += [(503, "é\xa0ü " * 30), (504, "w" * 100_000 + " x" * 20_000)]
    table = docs(*rows, clashing=("rank", "tag", "spans"))
    got = substrings.remove_repeats(table).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == plain_removal(rows)
    assert substrings.remove_repeats(table.limit(0)).count() == 0


def test_rows_without_id_whose_texts_share_32_bits(spark):
    """Rows of equal id are told apart by more than a short hash."""
    long = " ".join(f"w{i}" for i in range(60))
    texts = spark.range(300_000).selectExpr(
        f"IF(id % 2 = 0, concat('{long} ', id), concat('short ', id)) AS text"
    )
    alike = texts.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("t"))
    pairs = [r.t for r in alike.filter("size(t) > 1").collect()]
    assert any(len({len(t) > 100 for t in pair}) == 2 for pair in pairs)
    rows = [(None, t) for pair in pairs for t in pair] + [(None, None), (3, long)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = substrings.remove_repeats(table).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == plain_removal(rows)



def test_equal_windows_have_equal_keys():
    rng = np.random.default_rng(6)
    passage = rng.integers(1, 40, 90).astype(np.uint64)
    words = np.concatenate([rng.integers(1, 40, 50).astype(np.uint64), passage, rng.integers(1, 9, 33).astype(np.uint64), passage])
    one = substrings.window_keys(words, np.array([0, len(words)]))
    two = substrings.window_keys(np.concatenate([passage, passage]), np.array([0, 90, 180]))
    last = 90 - substrings.WINDOW + 1
    assert (one[50 : 50 + last] == one[173 : 173 + last]).all()
    assert (one[50 : 50 + last] == two[:last]).all() and (two[:last] == two[90 : 90 + last]).all()
    assert (one > 0).mean() > 0.5


# --- Jaccard join -------------------------------------------------------------


def plain_sets(rows):
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        if not words:
            sets.append(frozenset())
        elif len(words) < 5:
            sets.append(frozenset([tuple(words)]))
        else:
            sets.append(frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)))
    return sets


def plain_components(rows):
    sets = plain_sets(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            root = find(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted(
        ((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str
    )


def near_rows(rng, common=True):
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(40))
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 6, 8, 10, 14, 20, 60, 200]))] for _ in range(40)]
    rows = []
    for i in range(260):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.1:
            words = words[: max(1, len(words) - rng.randint(1, 3))]
        text = " ".join(w.upper() if rng.random() < 0.2 else w for w in words)
        if common and i % 3 == 0:
            text = passage + " " + text
        rows.append((1000 - i, text))
    return rows


@pytest.mark.parametrize("task_shingles,frequent", [(3_000_000, 8), (200, 8), (3_000_000, 2)])
def test_clusters_equal_brute_force(docs, monkeypatch, task_shingles, frequent):
    monkeypatch.setattr(jaccard, "TASK_SHINGLES", task_shingles)
    monkeypatch.setattr(jaccard, "PASS_SHINGLES", 3000)
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    rows = near_rows(random.Random(7))
    rows += [(None, rows[0][1]), (None, "alone and null"), (5, None), (6, ""), (7, " \n"), (8, "A b"), (9, "a B")]
    rows += [(1000, rows[0][1]), (1000, "another text of that id"), (10, "ÄÖ ß"), (11, "äö ß"), (12, "x " * 50_000)]
    table = docs(*rows, clashing=("name", "n", "tag", "root", "component_id"))
    got = jaccard.cluster(table).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_components(rows)
    assert jaccard.cluster(table.limit(0)).count() == 0


def test_keep_one(docs):
    rows = near_rows(random.Random(8)) + [(5, None), (6, ""), (6, ""), (2000, "twice the same row here"), (2000, "twice the same row here")]
    table = docs(*rows, clashing=("tag",))
    kept = jaccard.keep_one(table)
    assert kept.columns == table.columns
    want = [d for d, _, c in plain_components(rows) if d == c]
    want.remove(2000)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    only_null = jaccard.keep_one(docs((None, "a b c d e f"), (None, "a b c d e f"), (None, "other words"))).collect()
    assert sorted(r.text for r in only_null) == ["a b c d e f", "other words"]


def rows_without_ids(rng):
    """Near copies of which a third have no id, and ids that are only linked through one without."""
    rows = [(None if i % 3 == 0 else d, text) for i, (d, text) in enumerate(near_rows(rng, common=False))]
    chain = [f"chain{i}" for i in range(72)]
    rows += [(d, " ".join(chain[k : k + 60])) for d, k in ((3001, 0), (None, 6), (3002, 12))]
    other = [f"other{i}" for i in range(62)]
    rows += [(None, " ".join(other[k : k + 60])) for k in (0, 1, 1, 1, 2)]
    # Rows of one id are documents of their own.
    rows += [(4000, " ".join(f"{w}{i}" for i in range(30))) for w in "abc"]
    rows += [(None, " ".join(f"{w}{i}" for i in range(29))) for w in "ab"]
    return rows


@pytest.mark.parametrize("task_shingles", [3_000_000, 200])
def test_clusters_through_rows_without_ids(docs, monkeypatch, task_shingles):
    monkeypatch.setattr(jaccard, "TASK_SHINGLES", task_shingles)
    monkeypatch.setattr(jaccard, "PASS_SHINGLES", 3000)
    rows = rows_without_ids(random.Random(10))
    want = plain_components(rows)
    got = jaccard.cluster(docs(*rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    assert (3002, 56, 3001) in want and (None, 56, 3001) in want and (None, 56, None) in want


def test_keep_one_of_rows_without_ids(docs):
    rows = rows_without_ids(random.Random(10))
    # With ids for all, the last ones for those that have none, every component keeps its least.
    numbered = [(100_000 + i if d is None else 10 * d + i % 10, text) for i, (d, text) in enumerate(rows)]
    assert len({d for d, _ in numbered}) == len(rows)
    kept = {d for d, _, c in plain_components(numbered) if d == c}
    want = [None if d >= 100_000 else d // 10 for d in kept]
    got = [r.doc_id for r in jaccard.keep_one(docs(*rows)).collect()]
    assert Counter(got) == Counter(want) and None in want


@pytest.mark.parametrize("count", [2, 3, 50])
def test_local_join_rebuilds_its_lists(count):
    rng = np.random.default_rng(count)
    base = rng.integers(0, 1 << 60, 40).astype(np.uint64)
    sets = [np.unique(np.where(rng.random(40) < 0.06, rng.integers(0, 1 << 60, 40).astype(np.uint64), base)) for _ in range(count)]
    label = jaccard.join_sets(sets)
    same = lambda a, b: 7 * len(np.intersect1d(a, b)) >= 3 * (len(a) + len(b))
    for i in range(count):
        for j in range(i):
            if same(sets[i], sets[j]):
                assert label[i] == label[j]


def test_a_batch_is_filed_in_one_row_for_each_bucket():
    """One batch of rows for all buckets, however many: their number must not multiply the work."""
    texts = [t for _, t in near_rows(random.Random(11))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    (names, sizes, sets), = jaccard._gathered([batch])
    for buckets in (1, 7, 600):
        dealt = [b for b in jaccard._file(buckets, np.empty(0, dtype=np.uint64), 8)([batch]) if b.column("keys")[0].as_py()]
        assert len(dealt) == 1 and len(dealt[0]) <= buckets
        got = set()
        for row in dealt[0].to_pylist():
            own = np.frombuffer(row["sets"], "<u4")
            key = np.frombuffer(row["keys"], "<u8")
            name, size = (np.frombuffer(row[c], "<i8") for c in ("names", "sizes"))
            assert len(own) == len(key) == len(row["ties"]) and len(name) == len(size) == len(set(own.tolist()))
            assert {int(b) for b in (mix(key) >> np.uint64(33)) % np.uint64(buckets)} == {row["bucket"]}
            got |= set(zip(key.tolist(), name[own].tolist(), size[own].tolist()))
        if buckets == 1:
            want = got
        assert got == want
    keys = {(k, n, s) for n, s, own in zip(names.tolist(), sizes.tolist(), sets)
            for k in jaccard.signatures(own, np.zeros(len(own), dtype=int), 8).tolist()}
    assert want <= keys and {k for k, _, _ in want} == {k for k, _, _ in keys}


def test_documents_and_counts_come_from_one_pass(spark, docs):
    """Every text is cut into shingles once for both."""
    cut = spark.sparkContext.accumulator(0)
    sets_of = jaccard.shingle_sets

    def counted(texts):
        cut.add(len(texts))
        return sets_of(texts)

    survey = types.FunctionType(jaccard.survey.__code__, {**vars(jaccard), "shingle_sets": counted})
    table = docs(*near_rows(random.Random(12)))
    texts = table.selectExpr("doc_id", "xxhash64(text) AS tag", "text")
    rows, counts = survey(texts)
    assert rows.count() == 260 and cut.value == 260 and counts.count() > 0
    want = Counter(x for s in sets_of(pa.array([r.text for r in table.collect()])) for x in s.view(np.int64).tolist())
    assert all(want[r.shingle] >= r.times > 1 for r in counts.collect())


def test_quick_hashes_tell_words_apart():
    words = ["", "a", "A", "ab", "abcdefgh", "abcdefghi", "abcdefgh\0", "a\0", "x" * 63, "x" * 64, "x" * 65, "x" * 64 + "y", "x" * 500, "é"]
    texts = arrays.split_words(pa.array([" ".join(words + words[::-1]), "\t".join(words).upper(), None]))
    found = texts.quick_hashes(lower=True)
    same = [bytes(texts.data[a:b]).lower() for a, b in zip(texts.starts, texts.ends)]
    assert len(same) == 3 * (len(words) - 1) and len(set(same)) == len(set(found.tolist())) == len(set(zip(same, found.tolist())))
    assert np.array_equal(arrays.split_words(pa.array(["é", "x" * 500])).quick_hashes(), arrays.split_words(pa.array(["é " + "x" * 500])).quick_hashes())


def test_boundary_follows_the_lists():
    assert jaccard.boundary(1.0) < jaccard.boundary(50.0) <= jaccard.MOST_BOUNDARY


def test_components(spark):
    rng = random.Random(9)
    pairs = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, 100 + k) for k in range(1, 90)]
    pairs += [(rng.randint(300, 340), rng.randint(300, 340)) for _ in range(25)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    for start in {a for a, b in pairs if a != b}:
        reached, todo = {start}, [start]
        while todo:
            new = near[todo.pop()] - reached
            reached |= new
            todo += new
        assert {got[n] for n in reached if n in got} == {min(reached)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination ----------------------------------------------------------


def plain_edits(passage, text):
    """Least edits of the passage against any part of the text."""
    row = np.zeros(len(text) + 1, dtype=int)
    for c in passage:
        now = row + 1
        now[1:] = np.minimum(now[1:], row[:-1] + [c != t for t in text])
        for j in range(1, len(now)):
            now[j] = min(now[j], now[j - 1] + 1)
        row = now
    return int(row.min())


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.4:
            out[at] = rng.choice("abcdef")
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, rng.choice("abcdef"))
    return "".join(out)


def test_matches_equal_brute_force():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 20)))) for i in range(6)]
    block = decontaminate.Passages([*items, (90, None), (91, "short"), (92, "")])
    texts = []
    for i in range(60):
        text = " ".join(word() for _ in range(rng.randint(0, 30)))
        if i % 2:
            _, item = rng.choice(items)
            text += " " + edited(rng, item, rng.randint(0, 14)) + " " + word()
        texts.append(text)
    found = block.find(pa.array([*texts, None, ""], pa.string()))
    assert found[-2:] == [[], []]
    hits = 0
    for text, got in zip(texts, found):
        normal = decontaminate.normal_bytes(text).decode()
        for item, passage in items:
            edits = plain_edits(decontaminate.normal_bytes(passage).decode(), normal)
            allowed = decontaminate.edits_allowed(len(passage))
            assert dict(got).get(item) == (edits if edits <= allowed else None)
            hits += edits <= allowed
    assert hits > 10


@pytest.mark.parametrize("block_bytes", [4 << 20, 100])
def test_decontamination_operator(spark, docs, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    passage = "The quick brown fox, it jumps over the lazy dog every single morning."
    other = "Pack my box with five dozen liquor jugs, said the old man to his son."
    rows = [(1, f"words before {passage.upper()} and after"), (2, "nothing of that kind"), (3, None), (4, ""),
            (5, f"{other}\n\n{passage}"), (5, f"{other}\n\n{passage}"), (None, passage.replace(" ", "  ")), (6, "z " * 200_000)]
    benchmark = spark.createDataFrame([(0, passage, "x"), (1, other, "x"), (2, None, "x"), (None, other, "x")], "item_id long, text string, leaks string")
    table = docs(*rows)
    found = Counter((r.doc_id, tuple(sorted(-1 if x.item_id is None else x.item_id for x in r.leaks))) for r in decontaminate.find(table, benchmark).collect())
    assert found == {
        (1, (0,)): 1, (2, ()): 1, (3, ()): 1, (4, ()): 1, (5, (-1, 0, 1)): 2, (None, (0,)): 1, (6, ()): 1
    }
    left = decontaminate.clean(table, benchmark)
    assert left.columns == table.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 6]
    assert decontaminate.clean(table, benchmark.limit(0)).count() == len(rows)
    assert decontaminate.clean(table.limit(0), benchmark).count() == 0


def test_all_whole_passages_are_found(spark):
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_decontamination"](spark, "/root/testdata/sf0.01").collect()}
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    whole = {(d.doc_id, b.item_id) for d in documents for b in items if b.text in d.text}
    assert whole and whole <= got


# --- pipeline -----------------------------------------------------------------


def test_pipeline_stages(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("*", "1 AS score", "'x' AS __row", "2 AS tag")
    before = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL)
        assert after.columns == table.columns, name
        if name != "source_mixing":
            assert after.exceptAll(before).isEmpty(), name
        before = spark.createDataFrame(after.collect(), after.schema)
        assert before.count() > 0
        empty = stage(spark, table.limit(0), SMALL)
        assert empty.count() == 0 and empty.columns == table.columns
    last = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert last.count() == before.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "decontamination", "source_mixing", "token_files"]


def test_pipeline_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("name", ["op4_substring_dedup", "op8_jaccard_join"])
def test_query_equals_its_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == sql_rows(connect(SMALL), ORACLE[name])


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


def edge_rows(spark):
    """Clean documents, and rows with nulls, no words, repeats, ties and very long texts."""
    clean = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(60)
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    words = [r.text for r in clean.orderBy("doc_id").collect()]
    long = " ".join(words[:20]) * 3
    odd = [
        (900, None, "en", "s", None), (900, None, "en", "s", None), (901, "", None, None, None), (902, " \t", "en", "s", 2),
        (903, "12345 67890", "en", "s", 11), (None, long, None, None, None), (904, long, "en", None, None),
        (905, long, "en", "s", None), (905, long, "en", "s", None), (905, long + " tie", "en", "s", None),
    ]
    return clean.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame(odd, kind)), long


def test_stages_give_odd_rows_their_defined_results(spark):
    table, long = edge_rows(spark)
    stages = dict(corpus_pipeline.STAGES)

    def odd(name):
        rows = stages[name](spark, table, SMALL).collect()
        return Counter((r.doc_id, r.text) for r in rows if r.doc_id is None or r.doc_id >= 900)

    every = Counter((r.doc_id, r.text) for r in table.collect() if r.doc_id is None or r.doc_id >= 900)
    told = odd("language_id")
    assert not any(d in (900, 901, 902, 903) for d, _ in told)
    # Rows of one text are judged alike, each of them.
    assert {told[k] for k in every if k[1] == long} in ({0}, {1, 2})
    kept = odd("near_duplicates")
    assert (kept[900, None], kept[901, ""], kept[902, " \t"], kept[903, "12345 67890"]) == (2, 1, 1, 1)
    assert kept[904, long] == 1 and sum(n for (d, t), n in kept.items() if t and t.startswith(long)) == 1
    searched = odd("decontamination")
    assert all(searched[k] in (0, n) for k, n in every.items()) and searched[900, None] == 2
    mixed = odd("source_mixing")
    assert not any((t or "").strip() == "" for _, t in mixed)
    assert all(n <= 3 * every[k] for k, n in mixed.items())


def test_token_report_of_odd_rows(spark):
    table, _ = edge_rows(spark)
    report = dict(corpus_pipeline.STAGES)["token_files"](spark, table, SMALL)
    rows = sorted(report.collect(), key=lambda r: r.start)
    assert len(rows) == table.count()
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d))
    assert [r.n_tokens for r in rows if r.doc_id in (900, 901)] == [1, 1, 1]
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]

"""Components, near vectors, near documents and near lines against brute force on small fixtures."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyline.llm import components, embedding_dedup, line_dedup, linking, minhash_dedup


class Sets:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, i):
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def link(self, i, j):
        i, j = sorted((self.find(i), self.find(j)))
        self.parent[j] = i


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(300, i) for i in range(301, 340)] + [(5, 5), (None, 3)]
    edges += [(rnd.randrange(400, 480), rnd.randrange(400, 480)) for _ in range(40)]
    sets = Sets(range(500))
    for a, b in edges:
        if a is not None:
            sets.link(a, b)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    assert got == {i: sets.find(i) for a, b in edges if a is not None and a != b for i in (a, b)}
    assert components.connected_components(df.limit(0)).count() == 0


def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for i in range(240):
        base = rng.normal(size=16)
        for k in range((i % 4) * (i % 3)):
            rows.append((base + rng.normal(size=16) * 0.11, i % 3))
        rows.append((base, i % 3))
    center = rng.normal(size=16)
    rows += [(center + rng.normal(size=16) * 0.1, 1) for _ in range(150)] + [(center, 1)] * 20
    return [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(rows)]


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 32)
    rows = vectors()
    odd = [
        (9000, None, 1), (9001, [0.0] * 16, 1), (9002, [float("nan")] + [1.0] * 15, 1), (9003, [None] + [1.0] * 15, 1),
        (9004, rows[0][1], None), (9005, rows[0][1][:8], 0), (9006, [float("inf")] * 16, 1), (9007, [], 0),
    ]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, label int").withColumn("kept", F.lit(1))
    got = {r["vec_id"]: r for r in embedding_dedup.link_embeddings(df, recall=1.0).collect()}
    sets, links = Sets([r[0] for r in rows]), Counter()
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    for i, _, a in rows:
        for j, _, b in rows[:i]:
            if a == b and unit[i] @ unit[j] >= 0.98:
                links.update((i, j))
                sets.link(i, j)
    found = sum(got[i]["n_links"] for i, _, _ in rows)
    assert found >= 0.99 * sum(links.values()) and all(got[i]["n_links"] <= links[i] for i, _, _ in rows)
    wrong = [i for i, _, _ in rows if got[i]["component_id"] != sets.find(i)]
    assert len(wrong) <= 0.01 * len(rows)
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i, _, _ in rows)
    for i, *_ in odd:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert embedding_dedup.link_embeddings(df.limit(0)).count() == 0


def test_cells_come_in_order_of_distance():
    rng = np.random.default_rng(3)
    a, b = rng.random(7), rng.random(9)
    cells = list(embedding_dedup.nearest_cells(a, b, 0.9))
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums) and len(set(cells)) == len(cells) == ((a[:, None] + b) <= 0.9).sum()


def slow_similarity(x, y):
    """Probability Jaccard similarity from its definition."""
    x, y = ({k: 1 + np.log(n) for k, n in c.items()} for c in (x, y))
    both = x.keys() | y.keys()
    return sum(
        1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in both) for i in x.keys() & y.keys()
    )


def words_of(text):
    words = minhash_dedup.WORD.findall((text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else Counter()


def near_texts():
    rnd = random.Random(4)
    texts = []
    for group in range(12):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice((6, 40, 120)))]
        for _ in range(rnd.choice((1, 2, 9))):
            copy = list(base)
            for _ in range(rnd.choice((0, 0, 1, 2, 3))):
                copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(10**6)}"
            texts.append(" ".join(copy) + rnd.choice(("", ".", " again and again " * 3)))
    return texts + ["One two.", "one TWO", "", None, "..."]


@pytest.mark.parametrize("block", [512, 3])
def test_documents(documents, monkeypatch, block):
    monkeypatch.setattr(linking, "BLOCK", block)
    texts = near_texts()
    sets, shingles = Sets(range(len(texts))), [words_of(t) for t in texts]
    for i, a in enumerate(shingles):
        for j, b in enumerate(shingles[:i]):
            if a and b and slow_similarity(a, b) >= 0.8:
                sets.link(i, j)
    df = documents(*texts).withColumn("kept", F.lit("x"))
    got = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(df).collect()}
    assert {i: r["class_id"] for i, r in got.items()} == {i: sets.find(i) for i in got}
    assert len(got) == len(texts) and all(r["kept"] == (r["class_id"] == i) for i, r in got.items())


def test_documents_without_keys_and_repeated_rows(documents):
    rows = minhash_dedup.near_duplicates(documents((None, "a b c"), (7, "a b c"), (7, "a b c"), (9, "a b c"))).collect()
    assert sorted((str(r["doc_id"]), r["class_id"], r["kept"]) for r in rows) == [
        ("7", 7, True), ("7", 7, True), ("9", 7, False), ("None", None, True)
    ]
    assert minhash_dedup.near_duplicates(documents().limit(0)).count() == 0


def test_registers_agree_as_often_as_texts_are_alike():
    rng = np.random.default_rng(5)
    a = {f"a{i}": int(n) for i, n in enumerate(rng.integers(1, 6, 60))}
    b = {k: n + (i % 3 == 0) for i, (k, n) in enumerate(a.items()) if i % 5} | {"b1": 2, "b2": 9}
    names = {k: np.uint64(i * 7919 + 1) for i, k in enumerate(sorted(a.keys() | b.keys()))}
    hits = []
    for salt in range(60):
        sides = [
            minhash_dedup.signatures(
                np.zeros(len(c), np.int64),
                minhash_dedup._mix(np.array([names[k] for k in c]) + np.uint64(salt << 32)),
                np.array(list(c.values())), 1,
            )
            for c in (a, b)
        ]
        hits.append((sides[0] == sides[1]).mean())
    assert abs(np.mean(hits) - slow_similarity(Counter(a), Counter(b))) < 0.02


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def test_edit_similarity():
    rnd = random.Random(6)
    for _ in range(500):
        a, b = ("".join(rnd.choices("abé", k=rnd.randint(0, 12))) for _ in range(2))
        assert line_dedup.edit_similarity(a, b) == pytest.approx(1 - distance(a, b) / max(len(a), len(b), 1))


def test_registers_agree_as_often_as_grams():
    rnd = random.Random(5)
    shared = []
    for n in (12, 60, 400):
        a = "".join(rnd.choices("etaoin shrdlu", k=n))
        b = a[: 2 * n // 3] + "".join(rnd.choices("etaoin shrdlu", k=n // 3))
        grams = [{t[i : i + line_dedup.GRAM] for i in range(len(t) - line_dedup.GRAM + 1)} for t in (a, b)]
        shared.append(len(grams[0] & grams[1]) / len(grams[0] | grams[1]))
        found = line_dedup.registers([a, "between them", b])
        assert (found > 0).all()
        assert abs((found[0] == found[2]).mean() - shared[-1]) < 0.17
    # What a line gets does not follow from the lines beside it.
    lines = ["some line of words", "", "é", "ab" * 5000, "x\ud800y is no text at all"]
    keys, prints = line_dedup.bands(lines)
    for i, line in enumerate(lines):
        own = line_dedup.bands([line])
        assert (own[0][0] == keys[i]).all() and own[1][0] == prints[i]


@pytest.mark.parametrize("block", [512, 3])
def test_lines(documents, monkeypatch, block):
    monkeypatch.setattr(linking, "BLOCK", block)
    rnd = random.Random(8)
    long = [" ".join(f"w{rnd.randrange(300)}" for _ in range(90)) for _ in range(6)]
    pool = [line.replace(f" {line.split()[k]} ", f" y{k} ", 1) for line in long for k in (3, 30, 60)] + long
    pool += ["Short one.", "", "Five words are a line.", "five  words ARE a line."]
    texts = ["\n".join(rnd.choices(pool, k=rnd.randint(0, 7))) for _ in range(40)] + ["", None]
    places = [
        (i, p, line_dedup.normalised(line)) for i, t in enumerate(texts) for p, line in enumerate((t or "").split("\n"))
        if len(line.split()) >= 5
    ]
    names = sorted({line for _, _, line in places})
    sets = Sets(range(len(names)))
    for i in range(len(names)):
        for j in range(i):
            if line_dedup.edit_similarity(names[i], names[j]) >= 0.8:
                sets.link(i, j)
    assert len({sets.find(i) for i in range(len(names))}) < len(names)
    seen, gone = set(), set()
    for i, p, line in places:
        group = sets.find(names.index(line))
        if group in seen:
            gone.add((i, p))
        seen.add(group)
    rows = line_dedup.dedup_lines(documents(*texts).withColumn("n_removed", F.lit("x"))).orderBy("doc_id").collect()
    for i, (row, text) in enumerate(zip(rows, texts)):
        kept = [line for p, line in enumerate((text or "").split("\n")) if (i, p) not in gone]
        assert row["text"] == (None if text is None else "\n".join(kept))
        assert row["n_removed"] == sum(d == i for d, _ in gone)


def test_lines_without_keys_and_empty_tables(documents):
    line = "these five words come twice"
    rows = line_dedup.dedup_lines(documents((None, line), (1, line), (2, line))).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in rows) == [("1", line), ("2", ""), ("None", line)]
    assert line_dedup.dedup_lines(documents().limit(0)).count() == 0


def edited(rnd, words, share, single=False):
    """A line and the same with a share of its words, or of its single characters, replaced, one at least."""
    line = " ".join(words)
    new, letters = (list(line) if single else list(words)), "abcdefghijklmnopqrstuvwxyz"
    for k in rnd.sample(range(len(new)), max(1, int(share * len(new)))):
        new[k] = "".join(rnd.choices(letters, k=len(new[k])))
    return line, " ".join(("" if single else " ").join(new).split())


def recall(n_words, share, single=False, n=300):
    """Share of the line pairs of edit similarity 0.8 or more that meet as texts; nothing else gates them."""
    rnd = random.Random(n_words)
    vocabulary = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(3000)]
    pairs = [edited(rnd, rnd.choices(vocabulary, k=n_words), share, single) for _ in range(n)]
    pairs = [p for p in pairs if line_dedup.edit_similarity(*p) >= 0.8]
    keys, prints = line_dedup.bands([line for p in pairs for line in p])
    bits = np.bitwise_count((prints[::2] ^ prints[1::2]).view(np.uint64))
    return float(((keys[::2] == keys[1::2]).any(axis=1) & (bits <= line_dedup.MOST_BITS)).mean())


@pytest.mark.parametrize("n_words", [8, 12, 20, 30, 50, 120])
def test_lines_with_a_word_replaced_are_candidates(n_words):
    assert recall(n_words, 0) > 0.95
    assert recall(n_words, 0.1) > 0.95
    assert recall(n_words, 0.05, single=True) > 0.95


def test_lines_are_grouped_by_edit_similarity_alone(documents):
    rnd = random.Random(9)
    vocabulary = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randint(4, 9))) for _ in range(3000)]
    lines = [line for n in (8, 12, 20, 30, 50, 120) for _ in range(4) for line in edited(rnd, rnd.choices(vocabulary, k=n), 0)]
    alike = [line_dedup.edit_similarity(a, b) >= 0.8 for a, b in zip(lines[::2], lines[1::2])]
    rows = line_dedup.dedup_lines(documents(*lines)).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in rows] == [int(k) for near in alike for k in (0, near)]
    assert sum(alike) > 20


def test_alike_is_edit_similarity():
    rnd = random.Random(7)
    for _ in range(3000):
        a = "".join(rnd.choices("abc", k=rnd.randint(0, 12)))
        b = a[:3] + "".join(rnd.choices("abc", k=rnd.randint(0, 3))) + a[rnd.randint(3, 6) :]
        assert line_dedup.alike(a, b) == (distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9)


def pairs_of_lines(rnd):
    """Texts and edited, turned, or unlike ones, of few and of many different characters."""
    for _ in range(1500):
        letters = rnd.choice(("ab", "abcdé \0", "".join(map(chr, range(60, 400))), "\U0001f600x\ud800"))
        n = rnd.choice((0, 1, 20, 63, 64, 65, 129, 400))
        a = "".join(rnd.choices(letters, k=n))
        b = list(a) if rnd.random() < 0.8 else rnd.choices(letters, k=n)
        turn = rnd.choice((0, 0, 0, rnd.randint(0, n)))
        b = b[turn:] + b[:turn]
        for _ in range(rnd.randint(0, n // 4 + 1)):
            at = rnd.randint(0, len(b))
            b[at : at + rnd.randint(0, 1)] = rnd.choices(letters, k=rnd.randint(0, 1))
        yield (a, "".join(b)) if rnd.random() < 0.5 else ("".join(b), a)


@pytest.mark.parametrize("together", [4096, 7])
def test_pairs_decided_together_are_alike(monkeypatch, together):
    monkeypatch.setattr(line_dedup, "TOGETHER", together)
    left, right = zip(*pairs_of_lines(random.Random(10)))
    expected = [line_dedup.alike(a, b) for a, b in zip(left, right)]
    assert line_dedup._all_alike(left, right).tolist() == expected
    assert 300 < sum(expected) < 1400
    assert len(line_dedup._all_alike([], [])) == 0


def test_few_pairs_are_compared_one_by_one(monkeypatch):
    rnd, exact = random.Random(11), []
    vocabulary = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(300)]
    pairs = [edited(rnd, rnd.choices(vocabulary, k=40), 0.1) for _ in range(300)]
    pairs += [tuple(" ".join(rnd.choices(vocabulary, k=40)) for _ in "ab") for _ in range(300)]
    expected = [line_dedup.alike(a, b) for a, b in pairs]
    slow = line_dedup.edit_similarity
    monkeypatch.setattr(line_dedup, "edit_similarity", lambda a, b: exact.append(1) or slow(a, b))
    assert line_dedup._all_alike(*map(list, zip(*pairs))).tolist() == expected
    assert sum(expected) >= 290 and len(exact) < 60


def test_buckets_of_a_task_ask_together():
    def compare(columns, classes):
        n = len(classes)
        linked = yield list(columns["id"][: n - 1]), list(columns["id"][1:])
        first = np.flatnonzero(linked)
        if columns["bucket"][0] == 2:
            yield [1], [2]
        return first, first + 1

    asked = []

    def decide(left, right):
        asked.append(len(left))
        return np.array([(a + b) % 10 == 1 for a, b in zip(left, right)])

    none = np.zeros(7, np.int64)
    ids = np.array([10, 11, 12, 20, 21, 15, 16])
    table = {"bucket": np.array([1, 1, 1, 2, 2, 3, 3]), "i": none, "j": none, "id": ids, "class": ids}
    found = linking._units(compare, decide)(pa.table(table)).to_pydict()
    assert asked == [4, 1] and found == {"a": [11, 16, 21], "b": [10, 15, 20]}


def test_tasks_are_bounded_with_one_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(linking, "BLOCK", 16)
    # All but one of a bucket are connected already: one comparison each. Then none of them are.
    ids = spark.range(400).select(F.lit(1).cast("bigint").alias("bucket"), "id")
    for name, copies in (("CASE WHEN id = 7 THEN 1 ELSE 0 END", 399 + 25 + 1), ("id % 2", None), ("id", None)):
        members = linking.laid_out(ids.withColumn("class", F.expr(name).cast("bigint")))
        rows = linking.dealt(members, 200)
        tasks = [r["count"] for r in rows.groupBy("task").count().collect()]
        assert max(tasks) < 3 * 200
        if copies:
            assert sum(tasks) == copies
        # Each two items of different classes meet in a unit.
        if name != "id":
            met = rows.alias("a").join(rows.alias("b"), ["bucket", "i", "j"]).where("a.class < b.class")
            n = ids.groupBy(F.expr(name)).count().agg(F.min("count") * F.max("count")).first()[0]
            assert met.select("a.id", "b.id").distinct().count() == n


def test_buckets_of_one_block_are_not_copied(spark):
    members = spark.range(600).select((F.col("id") % 10).alias("bucket"), "id", (F.col("id") % 7 % 2).alias("class"))
    rows = linking.dealt(linking.laid_out(members), 50).collect()
    assert sorted((r["bucket"], r["id"]) for r in rows) == sorted((i % 10, i) for i in range(600))
    assert len({(r["bucket"], r["i"], r["j"], r["task"]) for r in rows}) == 10


@pytest.mark.parametrize("block", [512, 4])
def test_rows_are_picked_once_in_any_unit(spark, monkeypatch, block):
    monkeypatch.setattr(linking, "BLOCK", block)
    members = spark.range(90).select((F.col("id") % 3).alias("bucket"), "id", (F.col("id") % 5).alias("class"))

    def pick(columns, classes):
        near = abs(columns["id"][:, None] - columns["id"]) == 12
        return np.flatnonzero((near & (classes[:, None] != classes)).any(axis=1))

    members = linking.laid_out(members)
    rows = linking.picked_in_buckets(members, pick, 20)
    assert rows.columns == members.columns
    assert sorted(r["id"] for r in rows.collect()) == list(range(90))
    assert linking.picked_in_buckets(members, lambda c, _: np.flatnonzero(c["id"] == 7), 20).count() == 1


def test_keys_that_lines_share():
    rnd, found = np.random.default_rng(12), []
    keys = rnd.integers(-(2**63), 2**63 - 1, (80, line_dedup.BANDS))
    keys[40:, 3], keys[60:, 5] = keys[:40, 3], keys[60, 5]
    lines = np.arange(80)
    lines[[11, 51]] = 10
    keys[11] = keys[10]
    batch = pa.RecordBatch.from_arrays([pa.array(lines), pa.array(list(keys))], names=["line", "bands"])
    dealt = [r for b in line_dedup._by_part(7)(iter([batch.slice(0, 50), batch.slice(50)])) for r in b.to_pylist()]
    for part in range(7):
        some = pa.table({c: [r[c] for r in dealt if r["part"] == part] for c in ("buckets", "ids")})
        found += [tuple(r.values()) for r in line_dedup._shared(some).to_pylist()]
    holders = {}
    for line, own in zip(lines.tolist(), keys.tolist()):
        for key in own:
            holders.setdefault(key, set()).add(line)
    assert sorted(found) == sorted((k, i) for k, ids in holders.items() if len(ids) > 1 for i in ids)


@pytest.mark.parametrize(("looked", "pairs"), [(1024, 1 << 18), (1024, 5), (4, 5)])
def test_lines_near_no_other_leave_their_bucket(monkeypatch, looked, pairs):
    monkeypatch.setattr(line_dedup, "LOOKED", looked)
    monkeypatch.setattr(line_dedup, "LOOKED_PAIRS", pairs)
    rnd = np.random.default_rng(13)
    buckets = rnd.integers(0, 60, 300)
    prints, sizes = rnd.integers(-(2**63), 2**63 - 1, 300), rnd.choice([40, 47, 90], 300)
    prints[::3] = prints[0] ^ (1 << rnd.integers(0, 60, 100))
    table = {"bucket": buckets, "id": np.arange(300), "print": prints, "size": sizes}
    expected = {}
    for i in range(300):
        others = [j for j in range(300) if j != i and buckets[i] == buckets[j]]
        bits = [int(np.bitwise_count((prints[i] ^ prints[j]).view(np.uint64))) for j in others]
        near = any(
            b <= line_dedup.MOST_BITS and abs(sizes[i] - sizes[j]) <= 0.2 * max(sizes[i], sizes[j]) + 1e-9
            for b, j in zip(bits, others)
        )
        if near or len(others) >= looked:
            expected[i] = buckets[i]
    got = line_dedup._with_near(pa.table(table)).to_pylist()
    assert {r["id"]: r["bucket"] for r in got} == expected and len(got) == len(expected) < 300
    counts = Counter(expected.values())
    assert all(r["n"] == counts[r["bucket"]] and r["print"] == prints[r["id"]] for r in got)


def test_pairs_below_the_threshold_are_decided_together(monkeypatch):
    rnd, alone = random.Random(14), []
    vocabulary = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(300)]
    pairs = [edited(rnd, rnd.choices(vocabulary, k=n), share) for n in (30, 60, 200) for share in (0.2, 0.3) for _ in range(60)]
    expected = [line_dedup.alike(a, b) for a, b in pairs]
    one = line_dedup._alone_within
    monkeypatch.setattr(line_dedup, "_alone_within", lambda *pair: alone.append(1) or one(*pair))
    assert line_dedup._all_alike(*map(list, zip(*pairs))).tolist() == expected
    assert 60 < sum(expected) < 300 and len(alone) < 40


@pytest.mark.parametrize("least", [-50, 4, 10**6])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh ", "".join(map(chr, range(0x4E00, 0x4F00))), "x\U0001f600\ud800"])
def test_bands_of_several_words_are_exact(monkeypatch, letters, least):
    monkeypatch.setattr(line_dedup, "LEAST_PAIRS", least)
    rnd, left, right, most = random.Random(15), [], [], []
    for _ in range(60):
        a = rnd.choices(letters, k=rnd.choice((5, 70, 200, 450)))
        b = list(a)
        for _ in range(rnd.randint(0, len(a) // 3)):
            at = rnd.randint(0, len(b))
            b[at : at + rnd.randint(0, 1)] = rnd.choices(letters, k=rnd.randint(0, 1))
        a, b = sorted((a, b), key=len, reverse=True)
        left.append("".join(a))
        right.append("".join(b))
        most.append(rnd.randint(0, 2 * len(a) // 3))
    most = np.array(most)
    found, open_ = line_dedup.within(left, right, most)
    for i in open_:
        found[i] = line_dedup._alone_within(left[i], right[i], int(most[i]))
    expected = [(1 - line_dedup.edit_similarity(a, b)) * len(a) <= k + 0.5 for a, b, k in zip(left, right, most)]
    # One pair at least is beyond its bound, and pairs left open are decided one by one.
    assert found.tolist() == expected and 10 < sum(expected) < 60
    assert (len(open_) > 0) == (least > 0) or least == 4


def test_lines_are_sketched_once_a_task():
    texts = ["one two three four five\nshort\nSIX seven eight  nine ten", None, "", "x y z x y\none two three four  five"]
    batch = pa.RecordBatch.from_pydict({"id": [4, 5, 6, 7], "text": texts})
    rows = [r for b in line_dedup._lines(iter([batch.slice(0, 3), batch.slice(3)])) for r in b.to_pylist()]
    assert [(r["id"], r["position"]) for r in rows] == [(4, 0), (4, 2), (7, 0), (7, 1)]
    assert rows[3] == {**rows[0], "id": 7, "position": 1, "print": None, "size": None, "bands": b""}
    named = ["one two three four five", "six seven eight nine ten", "x y z x y"]
    keys, prints = line_dedup.bands(named)
    for row, line, key, print_ in zip(rows, named, keys, prints):
        assert (row["size"], row["print"]) == (len(line), print_)
        assert np.frombuffer(row["bands"], np.int64).tolist() == key.tolist()


def test_first_line_of_a_document_stays_in_repeated_rows(documents):
    line = "these five words come often"
    rows = line_dedup.dropped_lines(documents((3, f"{line}\na\n{line}"), (2, f"b\n{line}\n{line}"), (2, f"{line}\nc")))
    assert sorted(map(tuple, rows.collect())) == [(2, [1, 2]), (3, [0, 2])]


def test_buckets_of_the_same_lines_are_one():
    bucket, id_ = [1, 1, 2, 2, 2, 3, 3, 4, 4], [7, -8, 7, -8, 9, -8, 7, 7, 9]
    named = line_dedup._named(pa.table({"bucket": bucket, "id": id_}))
    rows = line_dedup._once(named.append_column("n", pa.array(range(9)))).to_pylist()
    held = {}
    for row in rows:
        held.setdefault(row["bucket"], []).append(row["id"])
    assert sorted(sorted(ids) for ids in held.values()) == [[-8, 7], [-8, 7, 9], [7, 9]]
    none = pa.table({"bucket": pa.array([], pa.int64()), "id": pa.array([], pa.int64())})
    assert len(line_dedup._once(line_dedup._named(none))) == 0


def test_text_of_a_line_is_given_once_a_task():
    line = line_dedup.xxhash.xxh3_128_digest("one two three four five")
    places = [{"position": 1, "line": int.from_bytes(line[:8], "little", signed=True)}]
    table = {"text": ["a\nOne two  three four five", "a\nother", "b\none two three four five"], "places": [places] * 3}
    rows = [r for b in line_dedup._texts(iter([pa.RecordBatch.from_pydict(table)])) for r in b.to_pylist()]
    assert rows == [{"id": places[0]["line"], "text": "one two three four five"}]


def test_keys_of_some_bands():
    keys = np.arange(5 * line_dedup.BANDS).reshape(5, -1)
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(list(keys))], names=["line", "bands"])
    for k in (0, 1):
        rows = [r for b in line_dedup._by_part(3, slice(k, None, 2))(iter([batch])) for r in b.to_pylist()]
        found = [(key, line) for r in rows for key, line in zip(*(np.frombuffer(r[c], np.int64).tolist() for c in ("buckets", "ids")))]
        assert sorted(found) == [(key, i) for i, own in enumerate(keys.tolist()) for key in own[k::2]]


def sketch_columns(lines):
    _, planes = line_dedup.sketched(lines)
    return {"size": np.array([len(line) for line in lines]), "print": planes[0], **dict(zip(line_dedup.MORE, planes[1:]))}


def test_registers_agree_in_their_bits():
    rnd = random.Random(16)
    vocabulary = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(300)]
    lines = [line for share in (0, 0.1, 0.3, 0.5) for _ in range(40) for line in edited(rnd, rnd.choices(vocabulary, k=40), share)]
    found = line_dedup._mix(line_dedup.registers(lines)) & np.uint64(15)
    columns, sizes = sketch_columns(lines), np.array([len(line) for line in lines])
    i, j = (side.reshape(-1) for side in np.meshgrid(np.arange(len(lines)), np.arange(len(lines))))
    bits = ((found[i, :64] ^ found[j, :64]) & np.uint64(1)).sum(axis=1)
    first = (bits <= line_dedup.MOST_BITS) & (abs(sizes[i] - sizes[j]) <= 0.2 * np.maximum(sizes[i], sizes[j]) + 1e-9)
    expected = first & ((found[i] == found[j]).sum(axis=1) >= line_dedup.LEAST_SAME)
    assert line_dedup._close(columns, i, j).tolist() == expected.tolist()
    # Without the other bits of the registers more pairs are near.
    fewer = {c: columns[c] for c in ("size", "print")}
    assert line_dedup._close(fewer, i, j).tolist() == first.tolist() and first.sum() > expected.sum() > len(lines)


def test_unlike_lines_whose_fingerprints_are_near_do_not_meet():
    """Lines of common words share a key by chance, and their number grows with the square of the table."""
    rnd = random.Random(17)
    vocabulary = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 5))) for _ in range(120)]
    lines = [" ".join(rnd.choices(vocabulary, k=60)) for _ in range(2000)]
    keys, _ = line_dedup.bands(lines)
    columns, met = sketch_columns(lines), {}
    fewer = {c: columns[c] for c in ("size", "print")}
    for i, own in enumerate(keys.tolist()):
        for key in own:
            met.setdefault(key, []).append(i)
    pairs = {(a, b) for ids in met.values() for b in ids for a in ids if a < b}
    left, right = (np.array(side) for side in zip(*sorted(pairs)))
    by_chance, still = line_dedup._close(fewer, left, right), line_dedup._close(columns, left, right)
    texts = [np.array(lines)[side[by_chance & ~still]].tolist() for side in (left, right)]
    assert by_chance.sum() > 40 and still.sum() < by_chance.sum() / 4
    assert not line_dedup._all_alike(*texts).any()


@pytest.mark.parametrize("n_words", [8, 12, 20, 30, 50, 120])
def test_lines_that_are_alike_pass_all_of_the_sketch(n_words):
    rnd, missed, n = random.Random(n_words), 0, 0
    vocabulary = ["".join(rnd.choices("etaoinshrdlu", k=rnd.randint(2, 9))) for _ in range(3000)]
    for share, single in ((0, False), (0.1, False), (0.18, False), (0.05, True), (0.1, True)):
        pairs = [edited(rnd, rnd.choices(vocabulary, k=n_words), share, single) for _ in range(150)]
        pairs = [p for p in pairs if line_dedup.edit_similarity(*p) >= 0.8]
        columns = sketch_columns([line for p in pairs for line in p])
        i = np.arange(0, 2 * len(pairs), 2)
        first = line_dedup._close({c: columns[c] for c in ("size", "print")}, i, i + 1)
        missed += (first & ~line_dedup._close(columns, i, i + 1)).sum()
        n += len(pairs)
    assert missed <= 0.005 * n


@pytest.mark.parametrize("least", [1, 1 << 22])
def test_shared_buckets_meet_their_sketches_in_turns(documents, monkeypatch, least):
    for name, value in (("LEAST_PER_TURN", least), ("SKETCHES_PER_TASK", 3), ("LOOKED_PER_TASK", 7), ("KEYS_PER_TASK", 20)):
        monkeypatch.setattr(line_dedup, name, value)
    turns, one = [], line_dedup._shared_by_part
    monkeypatch.setattr(line_dedup, "_shared_by_part", lambda parts, turn, n: turns.append((turn, n)) or one(parts, turn, n))
    rnd = random.Random(18)
    words = [[f"w{rnd.randrange(900)}" for _ in range(40)] for _ in range(5)]
    lines = [" ".join(w[:k] + [f"y{k}"] + w[k + 1 :]) for w in words for k in (3, 9, 15, 21, 27, 33)]
    rows = line_dedup.dedup_lines(documents(*lines, "none of these five words")).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in rows] == [int(k % 6 > 0) for k in range(30)] + [0]
    assert [t for t, _ in turns] == list(range(turns[0][1])) and (len(turns) > 1) == (least == 1)


def test_sketches_meet_the_buckets_of_their_lines():
    rnd = np.random.default_rng(19)
    ids = rnd.integers(-(2**63), 2**63 - 1, 50)
    sketches = rnd.integers(-(2**63), 2**63 - 1, (50, len(line_dedup.SKETCH)))
    known = pa.RecordBatch.from_arrays([pa.array(c) for c in (ids, *sketches.T)], names=["line", *line_dedup.SKETCH])
    bucket, at = rnd.integers(0, 30, 120), rnd.integers(0, 50, 120)
    listed = line_dedup._listed(pa.table({"bucket": bucket, "id": ids[at]})).to_batches()[0]
    assert listed.column("n").to_pylist() == [120]
    left = [r for t in range(3) for b in line_dedup._shared_by_part(4, t, 3)(iter([listed])) for r in b.to_pylist()]
    right = [r for b in line_dedup._sketches_by_part(4)(iter([known.slice(0, 20), known.slice(20)])) for r in b.to_pylist()]
    found = []
    for part in range(4):
        shared = pa.Table.from_pylist([r for r in left if r["part"] == part])
        own = pa.Table.from_pylist([r for r in right if r["part"] == part])
        met = line_dedup._with_sketches(5)(shared, own)
        for row in met.to_pylist():
            rows = line_dedup._rows(pa.table({"rows": [row["rows"]]})).to_pylist()
            assert all(r["bucket"] % 5 == row["part"] for r in rows)
            found += [tuple(r.values()) for r in rows]
    assert sorted(found) == sorted((b, ids[k], *sketches[k]) for b, k in zip(bucket, at))

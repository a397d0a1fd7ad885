from collections import defaultdict

import cases
import numpy as np
import pytest

from weatherlake.llm import near_dedup, queries


def shingle_set(text):
    words = cases.words(cases.lower(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent=75):
    """Component by id of all rows with an id, from the exact sizes of all intersections."""
    sets = [(key, shingle_set(text)) for key, text in rows]
    where = defaultdict(list)
    for i, (_, own) in enumerate(sets):
        for shingle in own:
            where[shingle].append(i)
    shared = defaultdict(int)
    for held in where.values():
        for a, i in enumerate(held):
            for j in held[a + 1 :]:
                shared[i, j] += 1
    root = {key: key for key, _ in rows if key is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, j), n in shared.items():
        (a, left), (b, right) = sets[i], sets[j]
        if a is not None and b is not None and 100 * n >= percent * (len(left) + len(right) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return [(key, len(own), None if key is None else find(key)) for key, own in sets]


def check(docs, got):
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    got = got.collect()
    assert sorted(map(repr, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(map(repr, brute(rows)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


@pytest.mark.parametrize("table", [cases.edge, cases.documents, cases.clashing])
def test_equals_brute_force(spark, table):
    docs = table(spark)
    check(docs, near_dedup.mark_near_copies(docs))


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    check(spark.read.parquet(f"{folder}/documents.parquet"), queries.op9_minhash(spark, folder))


def chain(start, steps, words=40, moved=3):
    """Texts each of which is similar to the next, but the first and last are not."""
    return [" ".join(f"v{start}x{i}" for i in range(k * moved, k * moved + words)) for k in range(steps)]


def test_chains_become_one_component(spark):
    texts = [*chain(0, 12), *chain(1, 5), "alone " + " ".join(f"z{i}" for i in range(40))]
    docs = spark.createDataFrame([(100 - i, t, "en", "s", 1) for i, t in enumerate(texts)], cases.SCHEMA)
    got = near_dedup.mark_near_copies(docs)
    check(docs, got)
    assert len({row.component_id for row in got.collect()}) == 3


def test_a_large_group_of_near_copies(spark):
    base = [f"b{i}" for i in range(120)]
    rows = []
    for k in range(600):
        own = list(base)
        own[(7 * k) % 120] = f"n{k}"
        rows.append((k, " ".join(own), "en", "s", 1))
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    got = near_dedup.mark_near_copies(docs).collect()
    assert {row.component_id for row in got} == {0} and sum(row.kept for row in got) == 1


def test_similarity_at_the_limit(spark):
    # 100 shingles each with 6/7 of them shared: 6 / 8 of the union is exactly 75 per cent.
    base = " ".join(f"w{i}" for i in range(74))  # 70 shingles
    at = base + " " + " ".join(f"a{i}" for i in range(10))
    other = base + " " + " ".join(f"b{i}" for i in range(10))
    beyond = base + " " + " ".join(f"c{i}" for i in range(14))
    docs = spark.createDataFrame([(1, at, "en", "s", 1), (2, other, "en", "s", 1), (3, beyond, "en", "s", 1)], cases.SCHEMA)
    check(docs, near_dedup.mark_near_copies(docs))


def test_many_unlike_texts_in_a_bucket_are_all_compared(spark):
    """With one band of one value the buckets are large and nearly all pairs in them are unlike."""
    docs = cases.documents(spark)
    shape = near_dedup.Bands(permutations=2, rows=1)
    got = near_dedup.mark_near_copies(docs, shape=shape)
    links = brute([(r.doc_id, r.text) for r in docs.collect()])
    found = {r.doc_id: r.component_id for r in got.collect()}
    # Four bands of one value miss a link of 75 per cent with chance 1 in 256, so nearly all components agree.
    assert sum(found[key] == component for key, _, component in links) >= 0.97 * len(links)


def test_empty_table_and_columns(spark):
    assert near_dedup.mark_near_copies(cases.empty(spark)).count() == 0
    docs = cases.clashing(spark)
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(map(repr, [1, 2, 3, 4, None, 7, 8, 9, 10]))


def test_minimum_and_maximum_meet_as_often_as_sets_do():
    signer = near_dedup.Signer(near_dedup.Bands(permutations=512, rows=1))
    numbers = np.random.default_rng(2)
    shared, left, right = (np.unique(numbers.integers(0, 1 << 63, n).astype(np.uint64)) for n in (600, 200, 200))
    a, b = (signer.bands(np.unique(np.concatenate([shared, own]))) for own in (left, right))
    assert len(a) == 1024 and abs((a == b).mean() - 0.6) < 0.05


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in near_dedup.components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert {got.get(i, i) for i in range(41)} == {0} and {got.get(i, i) for i in range(100, 160)} == {100}


@pytest.fixture
def compared_pairs(monkeypatch):
    """The numbers of pairs whose sets are compared, call by call."""
    counts, real = [], near_dedup.confirmed

    def counted(pairs, sets, percent):
        counts.append(pairs.count())
        return real(pairs, sets, percent)

    monkeypatch.setattr(near_dedup, "confirmed", counted)
    return counts


def templated(n, shared=332, own=68, words=lambda k: "q"):
    """Texts alike in `shared` of their shingles; with 332 and 68 any two are 71 per cent alike."""
    base = " ".join(f"t{i}" for i in range(shared + 4))
    return [(k, base + " " + " ".join(f"{words(k)}{k}x{i}" for i in range(own)), "en", "s", 1) for k in range(n)]


def test_templated_texts_cost_a_few_pairs_each(spark, compared_pairs):
    found = {}
    for n in (400, 1500):
        compared_pairs.clear()
        docs = spark.createDataFrame(templated(n), cases.SCHEMA)
        got = near_dedup.mark_near_copies(docs).collect()
        assert all(row.component_id == row.doc_id for row in got)
        found[n] = sum(compared_pairs)
    assert found[400] < 40 * 400 and found[1500] < 40 * 1500, found


def test_links_in_crowded_buckets_are_all_found(spark, compared_pairs):
    """Brute force: pairs of 75 to 90 per cent among texts that are all about 70 per cent alike by one template."""
    numbers = np.random.default_rng(9)
    rows = templated(300)
    for k in range(0, 120, 2):
        words = rows[k][1].split()
        changed = list(words)
        for i in numbers.choice(np.arange(336, len(words)), int(numbers.integers(2, 25)), replace=False):
            changed[i] = f"c{k}y{i}"
        rows[k + 1] = (k + 1, " ".join(changed[: len(changed) - int(numbers.integers(0, 9))]), "en", "s", 1)
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    got = near_dedup.mark_near_copies(docs)
    check(docs, got)
    assert 20 < sum(not row.kept for row in got.collect()) <= 60


def test_texts_made_of_frequent_blocks_are_all_compared(spark):
    """No text has a shingle of its own, so their rarest elements are in many sets."""
    numbers = np.random.default_rng(4)
    blocks = [" ".join(f"b{i}w{j}" for j in range(40)) for i in range(14)]
    rows = [(k, " ".join(blocks[i] for i in sorted(numbers.choice(14, 10, replace=False))), "en", "s", 1) for k in range(250)]
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    check(docs, near_dedup.mark_near_copies(docs))


def test_the_rarest_elements_of_links_meet(spark):
    """Every pair at or above the limit shares an element of the prefixes that are joined, whatever the sizes."""
    numbers = np.random.default_rng(12)
    sets = {}
    for k in range(160):
        base = numbers.choice(60, int(numbers.integers(1, 40)), replace=False) if k % 2 == 0 else sets[k - 1]
        drop = numbers.random(len(base)) < 0.08
        sets[k] = np.unique(np.concatenate([np.array(base)[~drop], numbers.choice(60, int(numbers.integers(0, 4)))])).astype(np.int64)
    rows = [(k, [int(x) for x in own], []) for k, own in sets.items() if len(own)]
    frame = spark.createDataFrame(rows, "node LONG, elements ARRAY<LONG>, sketch ARRAY<LONG>")
    first = near_dedup.rarest_elements(frame, 75).collect()
    probed, listed = defaultdict(dict), defaultdict(dict)
    for row in first:
        probed[row.node][row.element] = row.place
        if row.listed:
            listed[row.node][row.element] = row.place
    links = 0
    for a, left, _ in rows:
        for b, right, _ in rows:
            n, m, both = len(left), len(right), len({*left} & {*right})
            if (m, b) < (n, a) and 100 * both >= 75 * (n + m - both):
                links += 1
                common = probed[a].keys() & listed[b].keys()
                assert any(175 * min(n - probed[a][e], m - listed[b][e]) >= 75 * (n + m) for e in common), (a, b)
    assert links > 30

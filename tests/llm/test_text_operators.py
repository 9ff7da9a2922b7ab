"""Exact copies, near copies, repeated passages and benchmark items against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from recordwise.llm import decontaminate, exact_dedup, ngram_join, repeat_removal
from recordwise.llm.graph import components
from recordwise.llm.run_index import RunIndex
from recordwise.llm.shingles import minhashes, multipliers, set_key, shingle_sets
from recordwise.llm.spans import buffer_of, slices

ODD = [
    (1, "a b c"), (2, "abc"), (3, "a bc"), (4, None), (5, ""), (6, " \t\n\v\f\r"), (7, "ab  c"), (7, "ab  c"),
    (None, "abc"), (9, "é" * 20_000), (10, "e" + "é" * 20_000), (11, "é" * 20_000 + " "),
]


def words(rnd, n, size=400):
    return [f"w{rnd.randrange(size)}" for _ in range(n)]


# --- slices of a batch


def test_slices_keep_every_row_and_text_whole():
    texts = ["", "x" * 50, None, "y" * 7, "", "z" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(slices(batch.slice(1), "text", 10))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts[1:]
    assert all(p.num_rows == 1 or buffer_of(p.column(0))[1][-1] <= 10 for p in parts)


# --- exact copies


def brute_copies(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i))
    found = Counter()
    for bare, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        digest = hashlib.sha256(bare.encode()).hexdigest()
        for place, m in enumerate(members):
            found[m[2], members[0][2], len(members), place == 0, digest] += 1
    return found


@pytest.mark.parametrize("words_log2", [1, 20])
def test_copies(docs, words_log2):
    rnd = random.Random(words_log2)
    rows = ODD + [(100 + k, " ".join(words(rnd, 2, 6))) for k in range(80)] + [(500 + k, "hot text" + " " * (k % 3)) for k in range(60)]
    got = Counter(tuple(r) for r in exact_dedup.copies(docs(rows), words_log2).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == brute_copies(rows)
    kept = exact_dedup.drop_copies(docs(rows), words_log2)
    assert kept.columns == docs([]).columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(k[0] for k, n in brute_copies(rows).items() if k[3] for _ in range(n))


def test_copies_of_nothing(docs):
    empty = docs([(1, "x")]).where("doc_id > 1")
    assert exact_dedup.copies(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


# --- near copies


def python_sets(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").lower())
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    return sets


def brute_links(rows):
    sets = python_sets([r for r in rows if r[0] is not None])
    ids = sorted(sets)
    parent, count = {i: i for i in ids}, Counter()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]):
                count[a] += 1
                count[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (root(i), count[i]) for i in ids}


@pytest.mark.parametrize("block", [3, 512])
def test_links(docs, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BUCKET_BLOCK", block)
    monkeypatch.setattr(ngram_join, "CLUSTER_BLOCK", block)
    rnd = random.Random(5)
    rows = [(1, None), (2, ""), (3, "one two"), (4, "One, TWO!"), (5, "two one"), (6, "?!"), (None, "a b c d e f g")]
    for group in range(6):
        base = words(rnd, rnd.choice([12, 60, 150]))
        for k in range(12):
            changed = list(base)
            for _ in range(rnd.randrange(0, 4)):
                changed[rnd.randrange(len(changed))] = f"x{rnd.randrange(9)}"
            rows.append((10 + group * 20 + k, " ".join(changed)))
    rows += [(1000 + k, " ".join(words(rnd, 80))) for k in range(20)]
    rows.append((2000, " ".join(words(rnd, 20_000))))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.jaccard_links(docs(rows)).collect()}
    assert got.pop(None) == (None, 0)
    assert got == brute_links(rows)
    kept = ngram_join.keep_one(docs(rows))
    assert kept.columns == docs([]).columns
    assert sorted(r[0] for r in kept.select("doc_id").collect() if r[0]) == sorted(i for i, (c, _) in brute_links(rows).items() if i == c)


def test_repeated_rows_and_no_rows(docs):
    text = "a b c d e f g h"
    got = ngram_join.jaccard_links(docs([(1, text), (1, text), (2, text)])).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == [(1, 1, 2), (1, 1, 2), (2, 1, 2)]
    assert ngram_join.jaccard_links(docs([(1, text)]).where("doc_id > 1")).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    """A pair of similarity t agrees in Bin(n, t) values; the bounds may drop it with a chance near the tolerance only."""
    steps = ngram_join.fewest_matches(0.8, 1e-6, 128)
    rnd = np.random.default_rng(1)
    agree = rnd.random((20_000, 128)) < 0.8
    dropped = np.zeros(len(agree), bool)
    for n, fewest in steps:
        dropped |= agree[:, :n].sum(1) < fewest
    assert dropped.mean() < 1e-3 and steps[-1][1] > 70
    unlike = rnd.random((2000, 128)) < 0.4
    assert np.mean([any(u[:n].sum() < m for n, m in steps) for u in unlike]) > 0.999


def test_minhash_estimates_similarity():
    rnd = random.Random(2)
    base = words(rnd, 300, 10**6)
    other = base[:250] + words(rnd, 50, 10**6)
    one, two = shingle_sets(*buffer_of(pa.array([" ".join(base), " ".join(other)])))
    exact = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
    factors = multipliers(1024)
    assert abs((minhashes(one, factors) == minhashes(two, factors)).mean() - exact) < 0.06
    assert set_key(one) == set_key(one[::-1].copy()) != set_key(two)


def test_components(spark):
    chain = [(k, k + 1) for k in range(100, 140)] + [(7, 9), (9, 8), (5, 5)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{k: 100 for k in range(100, 141)}, 7: 7, 8: 7, 9: 7, 5: 5}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- repeated passages


def test_run_index_finds_the_first_of_equal_windows():
    rnd = random.Random(1)
    for _ in range(150):
        phrases = ["".join(rnd.choices("ab", k=rnd.randint(1, 30))).encode() for _ in range(rnd.randint(1, 8))]
        length, index, first = rnd.choice([2, 3, 5, 8]), RunIndex(phrases), {}
        earliest = index.earliest(length)
        for k, p in enumerate(phrases):
            for i in range(len(p) - length + 1):
                place = index.starts[k] + i
                assert earliest[place] == first.setdefault(p[i : i + length], place)


def brute_removal(rows, length):
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    seen, found = {}, {}
    for known, i, t in order:
        data = t.encode()
        marked = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            if window in seen:
                marked[at : at + length] = True
            seen.setdefault(window, 1)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], marked, [0]])) == 1)
        kept = np.frombuffer(data, np.uint8)[~marked].tobytes()
        found[i if known else None] = (len(data), int(marked.sum()), len(edges), hashlib.sha256(kept).hexdigest(), kept)
    return found


@pytest.mark.parametrize("group_bytes", [60, 8 << 20])
def test_repeats(docs, group_bytes):
    rnd = random.Random(3)
    passages = ["".join(rnd.choices("abcd ", k=rnd.randint(25, 90))) for _ in range(6)]
    rows = [(None, passages[0]), (1, None), (2, ""), (3, "short"), (4, "ab" * 60), (5, "é" * 50), (6, passages[1] * 3)]
    for k in range(40):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else "".join(rnd.choices("efgh ", k=30)) for _ in range(4)]
        rows.append((10 + k, "".join(parts)))
    rows += [(60, rows[20][1]), (61, rows[20][1])]
    frame = repeat_removal.remove_repeats(docs(rows), length=24, group_bytes=group_bytes)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in frame.collect()}
    assert got == brute_removal(rows, 24)


def test_repeated_rows_lose_the_same(docs):
    rows = [(1, "x" * 150), (2, "y" * 10 + "q" * 99), (2, "y" * 10 + "q" * 99)]
    got = sorted((r["doc_id"], r["n_removed"]) for r in repeat_removal.remove_repeats(docs(rows)).collect())
    assert got == [(1, 149), (2, 0), (2, 0)]
    assert repeat_removal.remove_repeats(docs(rows).where("doc_id > 5")).count() == 0


# --- benchmark items


def edit_distance_to_part(item, text):
    row, best = list(range(len(item) + 1)), len(item)
    for c in text:
        before, row = row, [0]
        for k, x in enumerate(item, 1):
            row.append(min(before[k - 1] + (x != c), before[k] + 1, row[-1] + 1))
        best = min(best, row[-1])
    return best


def test_bit_parallel_distance_and_pigeonhole():
    rnd = random.Random(4)
    for _ in range(300):
        item = "".join(rnd.choices("abc ", k=rnd.randint(1, 70)))
        text = "".join(rnd.choices("abc ", k=rnd.randint(0, 120)))
        want = edit_distance_to_part(item, text)
        assert decontaminate.Item(1, item, 0.1).best(text)[0] == want
        for rate in (0.08, 0.25):
            found = decontaminate.Matcher([(1, item)], rate).matches(text)
            assert [m[1] for m in found] == ([want] if want <= int(rate * len(item) + 1e-9) else [])


def test_items_in_documents(spark, docs):
    rnd = random.Random(6)
    item = " ".join(words(rnd, 40))
    edited = item.replace(item[50:53], "zz", 1)
    items = spark.createDataFrame([(1, item), (2, "!!"), (3, None), (None, item), (5, " ".join(words(rnd, 30)))], "item_id bigint, text string")
    rows = [(1, "before " + item.upper() + " after"), (2, "x " + edited), (3, item[: len(item) // 2]), (4, None), (5, ""),
            (6, item.replace(" ", ",\n  ")), (7, " ".join(words(rnd, 9000))), (None, "y " + item), (8, item), (8, item)]
    for block in (10, 1 << 20):
        found = decontaminate.find_items(docs(rows), items, block_bytes=block).collect()
        assert Counter(r["doc_id"] for r in found) == {1: 2, 2: 2, 6: 2, None: 2, 8: 4}
        assert all(r["distance"] == 0 for r in found if r["doc_id"] != 2) and all(r["distance"] > 0 for r in found if r["doc_id"] == 2)
        kept = decontaminate.keep_clean(docs(rows), items, block_bytes=block)
        assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 7]
        assert kept.columns == docs([]).columns
    assert decontaminate.find_items(docs(rows), items.limit(0)).count() == 0


def test_stages_return_columns_of_any_names(spark, docs):
    rows = docs([(1, "one two three four five six seven"), (2, "one two three four five six seven"), (3, "nothing like it at all, not in the least")])
    items = spark.createDataFrame([(1, "nothing like it at all, not in the least"), (2, None)], "item_id long, text string")
    own = {"_sha": "a", "_best": "b", "_rank": "c", "_row": "d", "gone": "e", "_GONE": "f", "plain_text": "g"}
    for kept, ids in (
        (exact_dedup.drop_copies(rows), [1, 3]),
        (ngram_join.keep_one(rows), [1, 3]),
        (decontaminate.keep_clean(rows, items), [1, 2]),
    ):
        assert kept.columns == rows.columns
        found = sorted(kept.collect())
        assert [r.doc_id for r in found] == ids and all({n: r[n] for n in own} == own for r in found)

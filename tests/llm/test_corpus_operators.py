"""Operators over the whole corpus against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from wellspring.llm import balanced_shards, ngram_join, perspectives, suffix_tree_lm, url_lists
from wellspring.llm.components import components
from wellspring.llm.shared import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, k=5):
    w = tokens(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_classes(rows):
    """{(id, text): (n, component)} by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return {(d, t): (len(sets[i]), min(least[find(i)], default=d) if sets[i] else d) for i, (d, t) in enumerate(rows)}


def similar_rows(seed=5):
    """Chains, borderline pairs, shared passages, groups of copies."""
    r = random.Random(seed)
    word = lambda: f"t{r.randrange(3000)}"
    passage = [word() for _ in range(40)]
    out = []
    for g in range(12):
        base = [word() for _ in range(r.randrange(8, 160))]
        for c in range(r.randrange(1, 9)):
            w = base[:]
            for _ in range(r.randrange(0, 1 + len(w) // 18)):
                w[r.randrange(len(w))] = word()
            if r.random() < 0.4:
                w = passage + w
            if r.random() < 0.3:
                w = w[: int(len(w) * 0.8)]
            out.append((len(out) + 1, " ".join(w)))
    chain = [word() for _ in range(120)]
    for k in range(15):
        out.append((len(out) + 1, " ".join(chain[4 * k : 4 * k + 60])))
    out += [(len(out) + 1 + i, " ".join(passage)) for i in range(30)]
    out += [(500 + i, " ".join(passage + [f"own{i}"])) for i in range(30)]
    return out


@pytest.mark.parametrize("params", [ngram_join.JoinParams(), ngram_join.JoinParams(sketch_bits=8, split_rows=4, star_from=3, max_match=6, rounds=1)])
def test_ngram_join_equals_all_pairs(spark, rows, params):
    small = [(d, t) for d, t, *_ in rows if len(t or "") < 20_000] + similar_rows()
    want = brute_classes(small)
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in small], "doc_id long, text string, sig long, n int").repartition(5)
    got = ngram_join.similarity_classes(frame, params=params).collect()
    assert len(got) == len(small)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((d, *want[d, t]) for d, t in small)


def test_ngram_join_links_rows_without_id(spark):
    r = random.Random(8)
    base = [f"w{r.randrange(5000)}" for _ in range(400)]
    edit = lambda *at: " ".join(f"e{i}" if i in at else w for i, w in enumerate(base))
    far = [f"w{r.randrange(5000)}" for _ in range(300)]
    chain = [" ".join(far[k : k + 200]) for k in (0, 24, 48)]  # neighbours at 0.78, ends at 0.60
    rows = [(1, edit()), (None, edit(100)), (None, edit(100)), (2, "something else altogether here now"), (None, edit(200)), (10, chain[0]), (None, chain[1]), (20, chain[2]), (10, chain[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((x.doc_id, x.n_shingles, x.component_id) for x in ngram_join.similarity_classes(frame).collect())
    assert got == Counter((d, *brute_classes(rows)[(d, t)]) for d, t in rows)
    assert sum(k for (d, _, c), k in got.items() if d is None and c == 1) == 3 and (None, 196, 10) in got


def test_ngram_join_of_a_large_group_with_few_links_among_it(spark):
    r = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(260):
        w = base[:]
        for _ in range(r.randrange(2, 5)):
            w[r.randrange(len(w))] = f"x{i}-{r.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = {x.doc_id: x.component_id for x in ngram_join.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_classes(rows)
    assert got == {d: want[(d, t)][1] for d, t in rows} and len(set(got.values())) < 200


def test_ngram_join_lists_only_members_that_fit_the_sets_they_meet(spark, monkeypatch):
    p, listed, members = ngram_join.JoinParams(), [], ngram_join._first_members
    # a component of 300 sets in two long lists, that meets 40 sets of one size there; few of its members can be as much alike
    group = [(i, 0, 5 + i % 12, 5 + i % 12 if i % 5 == 0 else 4) for i in range(300)]
    lone = [(1000 + i, 1000 + i, 10, 10) for i in range(40)]
    rows = [(token, sig, n, 1, n - tail, 340, tail) for token in (1, 2) for sig, _, n, tail in group + lone]
    lists = spark.createDataFrame(rows, "token long, sig long, n int, matches byte, pos int, df long, tail int")
    comp = spark.createDataFrame([(sig, c) for sig, c, *_ in group + lone], "sig long, comp long")

    def pairs(how):
        monkeypatch.setattr(ngram_join, "_first_members", lambda *args: (listed.append(how(*args).cache()), listed[-1])[1])
        return {(x.a, x.b) for x in ngram_join._remaining_pairs(lists, comp, p, Workspace(spark, "fits")).collect()}

    def fits(x, y):
        return 100 * min(x[2], y[2]) >= 75 * max(x[2], y[2]) and 175 * min(x[3], y[3]) >= 75 * (x[2] + y[2])

    got = pairs(members)
    all_members = pairs(lambda apart, one, p: apart.select("token", "long", "comp_a", "comp_b").join(one, ["token", "comp_a"]))
    assert got == all_members and any(a < 300 for a, _ in got)
    of_group = [d.where("comp_a = 0").count() for d in listed]  # each list brings a member to a set only where the two fit
    assert of_group == [2 * sum(fits(x, y) for x in group for y in lone), 2 * 300 * 40]


def test_ngram_join_sketch_stays_compressed_on_the_driver(docs, rows):
    p = ngram_join.JoinParams()
    chunks, median = ngram_join._sketch(ngram_join._signed_and_counted(docs, "doc_id", "text", p), p)
    counters = ngram_join._counters(chunks, p)
    assert len(counters) == 1 << p.sketch_bits and sum(map(len, chunks.values())) < counters.nbytes // 8
    assert counters.sum() == sum(len(shingles(r[1])) for r in rows) and median == sorted(counters)[len(counters) // 2]


def test_ngram_join_ends_when_no_pair_is_left(spark, monkeypatch):
    written, write = [], Workspace.write
    monkeypatch.setattr(Workspace, "write", lambda self, df, name: (written.append(name), write(self, df, name))[1])
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(30)]
    got = ngram_join.similarity_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(x.component_id == x.doc_id for x in got) and len(got) == 30
    assert not [name for name in written if name.startswith("tried") or name.endswith("-comp")]


def test_ngram_join_long_text_and_empty_table(docs, no_docs):
    got = {r.doc_id: r for r in ngram_join.similarity_classes(docs).collect()}
    assert got[10_010].component_id == got[10_011].component_id == 10_010
    assert got[10_001].n_shingles == 0 and got[10_001].component_id == 10_001
    assert got[10_004].component_id == got[10_005].component_id == 10_004
    assert ngram_join.similarity_classes(no_docs).count() == 0


def test_choose_prefix_is_valid():
    import numpy as np

    p = ngram_join.JoinParams()
    for n in (1, 2, 5, 17, 300):
        need = -(-75 * n // 100)
        for est in (np.zeros(n), np.full(n, 1e6), np.arange(n) * 100.0):
            length, m = ngram_join.choose_prefix(est, n, p)
            assert 1 <= m <= need and length == n - need + m <= n
    cheap_tail = np.concatenate([np.full(80, 50.0), np.zeros(220)])
    assert ngram_join.choose_prefix(cheap_tail, 300, p)[1] > 1


def test_components_of_random_graphs(spark):
    r = random.Random(1)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = {x.node: x.root for x in components(spark.createDataFrame(links, "a long, b long"), Workspace(spark, "t"), "c").collect()}
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        if len(seen) > 1:
            assert got[start] == min(seen)


def test_suffix_tree_base_score_and_counts(docs, rows):
    learn = docs.where(~suffix_tree_lm.is_held_out("doc_id"))
    got = suffix_tree_lm.score(docs, learn, params=suffix_tree_lm.TreeParams(edge_share=1e-4)).collect()
    assert len(got) == len(rows)
    train = [t for d, t, *_ in rows if d is not None and zlib.crc32(str(d).encode()) % 7 != 2]
    c = Counter(w for t in train for w in [*tokens(t), None])
    total, distinct = sum(c.values()), len(c)
    by = defaultdict(list)
    for d, t, *_ in rows:
        w = [*tokens(t), None]
        by[d].append((len(w), sum(c[x] > 0 for x in w), sum(math.log10((c[x] + 1) / (total + distinct + 1)) for x in w)))
    for r in got:
        assert r.train_tokens == total
        assert any(r.n_tokens == n and r.n_known == k and r.base_score == pytest.approx(s) for n, k, s in by[r.doc_id])


def brute_tree(train, p):
    """Retained contexts and a probability function, by plain counting."""
    seqs = [[None, *tokens(t), 0] for t in train]  # None: start, 0: end
    uni = Counter(w for s in seqs for w in s[1:])
    total, distinct = sum(uni.values()), len(uni)
    least_e, least_c = max(p.least_edge, math.ceil(p.edge_share * total)), max(p.least_context, math.ceil(p.context_share * total))
    root = lambda w: (uni[w] + 1) / (total + distinct + 1)
    size = {(): total, (None,): len(seqs)} | {(w,): n for w, n in uni.items()}
    pairs, triples = Counter(), Counter()
    for s in seqs:
        pairs.update(zip(s, s[1:]))
        triples.update(zip(s, s[1:], s[2:]))
    size |= dict(pairs)
    states = {}

    def prob(w, context):
        while context and context not in states:
            context = context[1:]
        if not context:
            return root(w)
        listed, rest = states[context]
        return listed[w] if w in listed else rest * prob(w, context[1:])

    for counts, depth in ((pairs, 1), (triples, 2)):
        found = defaultdict(dict)
        for s, n in counts.items():
            ok = n >= least_e and uni[s[-1]] >= least_e and (size.get(s[:-1], 0) >= least_c or s[:-1] == (None,))
            if depth == 2:
                ok = ok and pairs[s[1:]] >= least_e and size.get(s[1:2], 0) >= least_c and (s[0] is None or size.get(s[:1], 0) >= least_c)
            if ok:
                found[s[:-1]][s[-1]] = n
        new = {}
        for context, listed in found.items():
            n = size[context]
            above = {w: prob(w, context[1:]) for w in listed}
            rest = max(1 - sum(listed.values()) / n, 0)
            kl = sum(k / n * math.log(k / n / above[w]) for w, k in listed.items())
            if rest > 0:
                kl += rest * math.log(rest / max(1 - sum(above.values()), 1e-12))
            if kl >= p.divergence and kl * n >= p.evidence:
                left = 1 - sum(k - p.discount for k in listed.values()) / n
                new[context] = ({w: (k - p.discount) / n + left * above[w] for w, k in listed.items()}, left)
        states.update(new)
    return states, prob


def test_suffix_tree_scores_by_definition(spark):
    r = random.Random(4)
    follow = {f"v{i}": [f"v{r.randrange(30)}" for _ in range(3)] for i in range(30)}
    texts = []
    for i in range(400):
        w = [f"v{r.randrange(30)}"]
        for _ in range(r.randrange(0, 40)):
            w.append(r.choice(follow.get(w[-1], ["v0"])) if r.random() < 0.9 else f"rare{r.randrange(400)}")
        texts.append((i, " ".join(w)))
    p = suffix_tree_lm.TreeParams(context_share=1e-3, edge_share=3e-4)
    train = [(i, t) for i, t in texts if i % 5]
    states, prob = brute_tree([t for _, t in train], p)
    assert len([s for s in states if len(s) == 1]) > 5
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = {x.doc_id: x for x in suffix_tree_lm.score(frame, frame.where("doc_id % 5 <> 0"), params=p).collect()}
    better = 0.0
    for i, t in texts:
        s = [None, *tokens(t), 0]
        want = sum(math.log10(prob(s[j], tuple(s[max(0, j - 2) : j]))) for j in range(1, len(s)))
        assert got[i].score == pytest.approx(want, rel=1e-9), i
        if i % 5 == 0:
            better += got[i].score - got[i].base_score
    assert better > 0
    vocabulary = {w for _, t in train for w in tokens(t)} | {0}
    for context in list(states)[:20]:
        assert sum(prob(w, context) for w in vocabulary) + prob("never seen", context) == pytest.approx(1.0)


def test_suffix_tree_empty(no_docs, docs):
    assert suffix_tree_lm.score(no_docs, no_docs).count() == 0
    got = suffix_tree_lm.score(docs, no_docs).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in got)


def brute_score(train, p, texts):
    """Scores under a tree of any depth, by plain counting."""
    seqs = [[None, *tokens(t), 0] for t in train]
    count = Counter(tuple(s[i : i + k]) for s in seqs for k in range(1, p.depth + 2) for i in range(len(s) - k + 1))
    n = sum(len(s) - 1 for s in seqs)
    distinct = len([q for q in count if len(q) == 1 and q != (None,)])
    states = {}

    def prob(q):
        if len(q) == 1:
            return (count[q] + 1) / (n + distinct + 1)
        below = prob(q[1:])
        listed, left = states.get(q[:-1], ({}, 1.0))
        return listed.get(q[-1], left * below)

    for k in range(1, p.depth + 1):
        found = defaultdict(dict)
        for q, c in count.items():
            if len(q) == k + 1 and c >= p.least_edge and (count[q[:-1]] >= p.least_context or q[:-1] == (None,)):
                found[q[:-1]][q[-1]] = c
        new = {}
        for s, listed in found.items():
            size, above = count[s], {w: prob((*s[1:], w)) for w in listed}
            rest = 1 - sum(listed.values()) / size
            kl = sum(c / size * math.log(c / size / above[w]) for w, c in listed.items())
            if rest > 0:
                kl += rest * math.log(rest / max(1 - sum(above.values()), 1e-12))
            if kl >= p.divergence and kl * size >= p.evidence:
                left = 1 - sum(c - p.discount for c in listed.values()) / size
                new[s] = ({w: (c - p.discount) / size + left * above[w] for w, c in listed.items()}, left)
        states.update(new)
    out = []
    for t in texts:
        s = [None, *tokens(t), 0]
        out.append(sum(math.log10(prob(tuple(s[max(0, i - p.depth) : i + 1]))) for i in range(1, len(s))))
    return out, Counter(map(len, states))


@pytest.mark.parametrize("depth, near", [(0, 1 << 20), (1, 1 << 20), (3, 1 << 20), (3, 8)])
def test_suffix_tree_of_any_depth(spark, monkeypatch, depth, near):
    monkeypatch.setattr(suffix_tree_lm, "_NEAR", near)  # small: most sequences meet their gains in the join
    r = random.Random(9)
    phrases = [[f"v{r.randrange(12)}" for _ in range(6)] for _ in range(12)]
    texts = [(i, " ".join(w for _ in range(r.randrange(5)) for w in [*r.choice(phrases), f"u{r.randrange(40)}"])) for i in range(200)]
    p = suffix_tree_lm.TreeParams(depth=depth)
    frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    want, states = brute_score([t for i, t in texts if i % 5], p, [t for _, t in texts])
    assert all(states[k] > 3 for k in range(1, depth + 1))
    got = {x.doc_id: x for x in suffix_tree_lm.score(frame, frame.where("doc_id % 5 <> 0"), params=p).collect()}
    for (i, _), w in zip(texts, want):
        assert got[i].score == pytest.approx(w, rel=1e-9), i


def test_suffix_tree_keeps_a_phrase_at_any_corpus_size(spark):
    phrase = "quartz lantern meadow harbour"
    rise = []
    for filler in (1, 600):
        texts = [(i, phrase) for i in range(12)] + [(100 + i, "some other words " * 1000) for i in range(filler)]
        frame = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
        got = suffix_tree_lm.score(frame.where("doc_id = 0"), frame).first()
        rise.append((got.train_tokens, got.score - got.base_score))
    assert rise[0][0] < 4_000 and rise[1][0] > 1_700_000  # 12 is less than 1e-5 of the larger corpus
    assert rise[1][1] > rise[0][1] > 1


def test_shards_are_even_and_keep_groups(spark, docs, rows):
    groups = [(50_000 + i, f"text of group {i % 7} with enough words to make a line of it") for i in range(700)]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(groups, "doc_id long, text string"))
    n = len(rows) + 700
    got = balanced_shards.assign(frame).collect()
    assert len(got) == n
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    texts = defaultdict(list)
    for d, t, *_ in rows:
        texts[d].append(t or "")
    for r in got:
        if r.doc_id in texts:
            assert (r.size, r.text_crc32) in {(len(t.encode()) + 8, zlib.crc32(t.encode())) for t in texts[r.doc_id]}
    where = defaultdict(set)
    for r in got:
        if (r.doc_id or 0) >= 50_000:
            where[(r.doc_id - 50_000) % 7].add(r.shard)
    even = n / 24
    assert all(len(s) <= math.ceil(100 / even) + 1 for s in where.values())


def test_shards_bring_linked_documents_together(spark):
    r = random.Random(2)
    line = lambda: " ".join(f"z{r.randrange(10**6)}" for _ in range(9))
    topics = [[line() for _ in range(4)] for _ in range(24)]
    texts = [(i, "\n".join([*r.sample(topics[i % 24], 2), line()])) for i in range(1200)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    p = balanced_shards.ShardParams(iterations=5, hub_start=False)
    got = {x.doc_id: x for x in balanced_shards.assign(frame, params=p).collect()}
    spread = lambda f: sum(1 - max(Counter(f(got[i]) for i, _ in texts if i % 24 == k).values()) / 50 for k in range(24)) / 24
    assert spread(lambda x: x.first_shard) > 0.8
    assert spread(lambda x: x.shard) < 0.5


def test_propagation_lowers_the_cut(spark):
    """With default parameters fewer links are cut at the end than at the start, and evening out adds little."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    p = balanced_shards.ShardParams()
    got = balanced_shards.assign(docs, params=p)
    placed = got.join(docs.select("doc_id", F.xxhash64("text").alias("content")), "doc_id").cache()
    _, edges = balanced_shards.documents_and_hubs(docs, "doc_id", "text", p)
    hubs = edges.groupBy("hub").count().where("count > 1").select("hub")
    edges = edges.join(hubs, "hub").cache()
    start, wished, end = (
        balanced_shards.cut_edges(placed.select("content", F.col(c).alias("shard")), edges).first().outside for c in ("first_shard", "wished_shard", "shard")
    )
    assert wished < 0.9 * start and end < 0.92 * start


def test_wishes_against_brute_force(spark):
    r = random.Random(4)
    units = [(c, part, r.randrange(1, 4), r.randrange(5)) for c in range(40) for part in range(1 + (c % 7 == 0))]
    edges = sorted({(r.randrange(40), h) for h in range(12) for _ in range(r.randrange(2, 9))})
    degree = Counter(h for _, h in edges)
    frame = spark.createDataFrame([(c, h, c % 3, degree[h]) for c, h in edges], "content long, hub long, salt int, degree long")
    state = spark.createDataFrame(units, "content long, part int, rows long, shard int")
    got = {(x.content, x.part): x for x in balanced_shards.wishes(state, frame).collect()}
    assert set(got) == {(c, part) for c, part, *_ in units if c in {e for e, _ in edges}}
    for c, part, n, shard in units:
        weight = defaultdict(float)
        for _, h in [e for e in edges if e[0] == c]:
            for c2, part2, n2, shard2 in units:
                if (c2, h) in edges and (c2, part2) != (c, part):
                    weight[shard2] += n2 / degree[h]
        if (c, part) in got:
            x = got[c, part]
            assert x.stay == pytest.approx(weight[shard]) and x.best == pytest.approx(max(weight.values()))
            assert weight[x.to] == pytest.approx(x.best)


def test_hubs_of_lines_and_shingles(spark, docs, rows):
    """Long lines and the least shingle hashes: equal for near copies, none for blank texts."""
    _, edges = balanced_shards.documents_and_hubs(docs, "doc_id", "text", balanced_shards.ShardParams(min_line_words=10**6))
    per = {x.content: set(x.hubs) for x in edges.groupBy("content").agg(F.collect_list("hub").alias("hubs")).collect()}
    for x in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("content")).collect():
        n = len(shingles(x.text)) if len(tokens(x.text)) >= 5 else 0
        assert len(per.get(x.content, ())) == min(4, n)
    key = {x.doc_id: x.content for x in docs.select("doc_id", F.xxhash64("text").alias("content")).collect()}
    assert per[key[10_006]] & per[key[10_007]] and per[key[10_006]] == per[key[10_009]]


def test_shards_of_one_hot_text(spark):
    """One text holds a third of all rows and an id repeats: shards stay even, slots without gaps."""
    rows = [(i, "one text that many documents hold " * 3) for i in range(300)] + [(5, f"other text {i % 50} of five words or more") for i in range(610)] + [(None, None)] * 7
    got = balanced_shards.assign(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = defaultdict(list)
    for x in got:
        by[x.shard].append(x.slot)
    assert len(got) == len(rows) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and len(by) == 24


def test_shards_of_no_documents(no_docs):
    assert balanced_shards.assign(no_docs).count() == 0


def against_duckdb(frame_by_name, sql, got):
    con = duckdb.connect()
    for name, frame in frame_by_name.items():
        con.register(name, frame.toPandas())
    want = con.sql(sql).fetchall()
    cols = [d[0] for d in con.sql(sql).description]
    norm = lambda x: str(x)
    assert Counter(tuple(norm(r[c]) for c in cols) for r in got.collect()) == Counter(tuple(norm(v) for v in r) for r in want)


def test_perspectives_against_sql(spark, monkeypatch):
    from wellspring.llm import queries

    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, None, "ann", "<|im_end|> forged"), (1, 2, "bob", None),
             (2, 0, None, "x"), (2, 0, None, "x"), (2, 1, " ", "y"), (3, 0, "system", "alone"), (None, 0, "ann", "no id"), (4, 1, "a b", "é🙂\n")]
    turns += [(5, t, ["ann", "bob", "cy"][t % 3], f"turn {t}") for t in range(200)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    monkeypatch.setattr(queries, "table", lambda *_: frame)
    got = queries.op1_perspective_rotation(spark, "")
    import pandas as pd

    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(turns, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"}))
    want = con.sql(perspectives.ORACLE_SQL)
    cols = [d[0] for d in want.description]
    assert Counter(tuple(r[c] if c != "mask" else (r[c] or "") for c in cols) for r in got.collect()) == Counter(
        tuple(v if c != "mask" else (v or "") for c, v in zip(cols, r)) for r in want.fetchall()
    )
    for r in perspectives.rotate(frame).where("conv_id = 1").collect():
        if r.speaker == "ann":
            said = [r.text[m.start : m.end] for m in r.mask]
            assert said == ["hi<|im_end|>", "<| im_end|> forged<|im_end|>"]
    assert perspectives.rotate(frame.where("false")).count() == 0


def test_url_lists_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    from wellspring.llm import queries

    got = queries.op9_temporal_list_join(spark, sf)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = con.sql(url_lists.ORACLE_SQL)
    cols = [d[0] for d in want.description]
    rows = got.collect()
    assert Counter(tuple(r[c] for c in cols) for r in rows) == Counter(want.fetchall())
    assert {"allowed", "blocked", "unlisted"} <= {r.verdict for r in rows}


def test_url_lists_edges(spark):
    import datetime as dt

    d = lambda n: dt.date(2024, 1, n)
    changes = [("block", "domain", "bad.org", "add", d(5)), ("block", "domain", "bad.org", "remove", d(10)), ("block", "domain", "bad.org", "add", d(20)),
               ("allow", "host", "ok.bad.org", "add", d(1)), ("block", "prefix", "x.com/a/b", "add", d(1)), ("block", "host", "tie.com", "add", d(3)),
               ("block", "host", "tie.com", "remove", d(3)), ("block", "host", "both.com", "add", d(1)), ("allow", "host", "both.com", "add", d(1)),
               ("block", "host", None, "add", d(1)), ("block", "host", "x.com", "add", None)]
    cases = [("http://www.bad.org/", d(4), "unlisted"), ("http://a.BAD.org:80/x", d(5), "blocked"), ("http://bad.org", d(10), "unlisted"),
             ("http://bad.org.", d(25), "blocked"), ("http://ok.bad.org/", d(6), "allowed"), ("http://notbad.org/", d(6), "unlisted"),
             ("http://x.com/a/b/c?q", d(2), "blocked"), ("http://x.com/a/bc", d(2), "unlisted"), ("http://tie.com", d(9), "unlisted"),
             ("http://both.com", d(2), "allowed"), (None, d(2), "no_host"), ("nonsense", d(2), "no_host"), ("http://bad.org", None, "unlisted"),
             ("http://" + "a." * 200 + "bad.org/", d(6), "no_host"), ("http://bad.org", d(10), "unlisted")]
    frame = spark.createDataFrame([(i, u, f, "mine") for i, (u, f, _) in enumerate(cases)], "page_id long, url string, fetched_at date, verdict string")
    lists = spark.createDataFrame(changes, "list string, kind string, value string, action string, changed_at date")
    got = {r.page_id: r.verdict for r in url_lists.evaluate(frame, lists).collect()}
    assert got == {i: v for i, (_, _, v) in enumerate(cases)}
    assert url_lists.evaluate(frame, lists.where("false")).where("verdict = 'blocked'").count() == 0
    assert url_lists.evaluate(frame.where("false"), lists).count() == 0

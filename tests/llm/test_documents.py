"""Operators on documents against brute force, and the odd rows that each must bear."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from wxpipe.llm import benchmark_scan, chosen_path, line_join, packing, repeat_index
from wxpipe.llm.common import fresh
from wxpipe.llm import components as llm_components
from wxpipe.llm.components import components
from wxpipe.llm.host_rules import BetaPrior, host_rules, judge_hosts
from wxpipe.llm.quality_fm import fit_quality, keep_quality, with_quality

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, score int"

SPACE = "[\x20\x09-\x0d]"
ODD = [
    None,
    "",
    " \t\n",
    "one",
    "Ab ab AB ab ab ab",
    "▁ a  b\n\nc é\U0001f600",
    "x" * 30_000,
    "word " * 5_000,
    "same line of text, long enough to count\nsame line of text, long enough to count",
    "same line of text, long enough to count",
    "same line of text, long enuogh to count",
]


def frame(spark, texts, first=0):
    rows = [(first + i, t, "en", f"s{i % 2}" if i else None, len(t or ""), "k", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark):
    """A small mix of real texts, near copies, shared passages and odd rows."""
    rng = random.Random(5)
    real = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(90).select("text").collect()]
    near = []
    for text in real[:12]:
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    passage = real[3][:300]
    texts = ODD + real + near + real[5:8] + [real[20] + passage, passage + real[21]]
    return texts


def documents(spark, texts):
    df = frame(spark, texts)
    twice = df.where("doc_id = 12")
    nameless = df.where("doc_id = 13").withColumn("doc_id", F.lit(None).cast("long"))
    return df.union(twice).union(nameless)


def by_id(rows):
    return {r["doc_id"]: r for r in rows if r["doc_id"] is not None}


def test_fresh_names_avoid_any_case():
    assert fresh(["A", "_a"], "a") == "__a"


def test_host_counts_match_brute_force(spark, corpus):
    got = by_id(host_rules(documents(spark, corpus)).collect())
    for i, text in enumerate(corpus):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        windows = [tuple(words[j : j + 3]) for j in range(len(words) - 2)]
        seen = collections.Counter(windows)
        covered = {j + k for j, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        row = got[i]
        assert row["n_words"] == len(words)
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == len(re.findall("[#*$%&|<>]", text or ""))
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(covered)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert row["base_failed"] == failed
        assert not (failed and row["kept"])


def test_bad_host_takes_its_documents_along(spark):
    good = "every word of this text is another one " + " ".join(f"w{i}" for i in range(60))
    rows = [(i, "bad" if i < 400 else f"host{i % 9}", good if i >= 380 else "short") for i in range(1300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    kept = {r["doc_id"]: r["kept"] for r in host_rules(docs).collect()}
    assert not any(kept[i] for i in range(400))
    assert all(kept[i] for i in range(400, 1300))
    shuffled = host_rules(docs, broadcast_bytes=0).where("kept").count()
    assert shuffled == 900


def rules_of(spark, hosts):
    rows = [(h, n < failed) for h, (docs, failed) in hosts.items() for n in range(docs)]
    return spark.createDataFrame(rows, "host string, base_failed boolean")


def test_the_limit_for_hosts_comes_from_the_prior(spark):
    """Chance rejects nobody; a host that fails moderately is rejected, and only that one."""
    rng = random.Random(9)
    chance = {f"h{n}": (200, sum(rng.random() < 0.1 for _ in range(200))) for n in range(60)}
    assert not judge_hosts(rules_of(spark, chance)).where("rejected").count()
    moderate = chance | {"bad": (200, 90), "few": (4, 3)}
    said = {r["host"]: r for r in judge_hosts(rules_of(spark, moderate)).collect()}
    assert [h for h, r in said.items() if r["rejected"]] == ["bad"]
    assert 0.3 < said["bad"]["host_rate"] < 0.45
    # A host that holds a third of all rows, and fails as the others do, stays.
    hot = chance | {"hot": (6000, 620)}
    assert not judge_hosts(rules_of(spark, hot)).where("rejected").count()


def test_quantiles_of_the_prior():
    assert BetaPrior(1, 1).quantile(0.99) == pytest.approx(0.99, abs=1e-4)
    assert BetaPrior(2, 1).quantile(0.25) == pytest.approx(0.5, abs=1e-4)
    assert BetaPrior(2, 38).limit() == pytest.approx(BetaPrior(2, 38).quantile(0.99))
    assert BetaPrior(0.1, 0.9).limit() == 0.5
    assert BetaPrior(1e5, 9e5).limit() == pytest.approx(0.25, abs=1e-6)


def test_repeats_in_a_long_text_are_exact(spark):
    """More than 65,536 words, repeats far apart, and hashes that all collide in their low bits."""
    rng = random.Random(10)
    words = [f"w{rng.randrange(60_000)}" for _ in range(90_000)] + ["p", "q", "r", "p", "q", "r"]
    words[70_000:70_010] = words[5:15]
    windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    docs = frame(spark, [" ".join(words), "a b c a b c", "a b c d", "a a a a", None])
    got = by_id(host_rules(docs).collect())
    assert [got[n]["n_repeat_words"] for n in range(5)] == [len(covered), 6, 0, 4, 0]


def test_prior_of_one_host_and_of_none(spark):
    rules = spark.createDataFrame([("a", True), ("a", False)], "host string, base_failed boolean")
    rate = judge_hosts(rules).first()["host_rate"]
    assert rate == pytest.approx(0.5)
    assert judge_hosts(rules.limit(0)).count() == 0
    assert BetaPrior(1.0, 1.0).failed == 1.0


def _windows(text, size=13):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return words, [tuple(words[i : i + min(size, len(words))]) for i in range(len(words) - min(size, len(words)) + 1)]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 100])
def test_contamination_matches_brute_force(spark, corpus, shard_bytes):
    items = [(1, " ".join(corpus[15].split()[4:30])), (2, "ONE"), (3, None), (4, ""), (None, "Ab, ab"), (5, corpus[16][:200])]
    table = spark.createDataFrame(items, "item_id long, text string")
    owners = collections.defaultdict(set)
    for item, text in items:
        words, windows = _windows(text)
        for w in windows if words else []:
            owners[w].add(item)
    got = benchmark_scan.contamination(documents(spark, corpus), table, shard_bytes=shard_bytes).collect()
    assert len(got) == len(corpus) + 2
    for i, row in by_id(got).items():
        words, _ = _windows(corpus[i])
        hit, found = set(), set()
        for pattern, who in owners.items():
            for j in range(len(words) - len(pattern) + 1):
                if tuple(words[j : j + len(pattern)]) == pattern:
                    hit |= set(range(j, j + len(pattern)))
                    found |= who
        assert (row["n_words"], row["n_hit"]) == (len(words), len(hit))
        assert row["items"] == sorted(str(x) for x in found - {None})
        marked = "".join((corpus[i] or "")[s["start"] : s["end"]] + " " for s in row["spans"])
        assert _windows(marked)[0] == [words[j] for j in sorted(hit)]
    clean = benchmark_scan.decontaminate(documents(spark, corpus), table)
    assert clean.columns == documents(spark, corpus).columns
    assert benchmark_scan.contamination(documents(spark, corpus).limit(0), table).count() == 0
    assert benchmark_scan.decontaminate(documents(spark, corpus), table.limit(0)).count() == len(corpus) + 2


def _components(texts, shingle, percent):
    sets = []
    for text in texts:
        words = re.split(SPACE + "+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "").strip(" \t\n\x0b\x0c\r"))
        words = [w for w in words if w]
        sets.append({tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)} or ({tuple(words)} if words else set()))
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    return sets, label


@pytest.mark.parametrize("leaf", [512, 4])
def test_near_duplicates_match_brute_force(spark, corpus, leaf):
    sets, label = _components(corpus, 3, 85)
    got = by_id(chosen_path.near_duplicates(documents(spark, corpus), shingle=3, percent=85, leaf=leaf).collect())
    assert [got[i]["n_shingles"] for i in range(len(corpus))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(corpus))] == label
    assert all(got[i]["kept"] == (label[i] == i) for i in range(len(corpus)))


def under_the_threshold(n, pairs, common, own):
    """Pages of ``common`` + ``own`` words, alike only in the common ones; the first ones in pairs share two more."""
    pages = []
    for i in range(n):
        words = [f"w{k}" for k in range(common)] + [f"p{i}x{k}" for k in range(own)]
        if i < 2 * pairs:
            words[-2:] = [f"pair{i // 2}x{k}" for k in range(2)]
        pages.append(" ".join(words))
    return pages


@pytest.mark.parametrize("depth", [2, chosen_path.DEPTH])
def test_pairs_hidden_in_a_group_just_under_the_threshold(spark, depth):
    # 91 of 100 words are everyone's (similarity 0.835); a pair shares 93 (0.869).
    pages = under_the_threshold(3000, 100, 91, 9)
    got = by_id(chosen_path.near_duplicates(frame(spark, pages), shingle=1, percent=85, depth=depth, leaf=64).collect())
    found = [got[2 * k + 1]["component_id"] == 2 * k for k in range(100)]
    assert sum(found) == 100
    assert sum(r["kept"] for r in got.values()) == 2900


def test_a_template_with_half_its_words_in_common(spark, monkeypatch):
    """Large nodes, but no rare word that many hold: no blocks, and every hidden pair is found."""
    pages = under_the_threshold(2000, 0, 50, 50)
    for k in range(60):  # a pair differs in three of its hundred words
        words = pages[2 * k].split(" ")
        pages[2 * k + 1] = " ".join([*words[:97], *(f"q{k}x{n}" for n in range(3))])
    monkeypatch.setattr(chosen_path, "_block_pairs", None)
    got = by_id(chosen_path.near_duplicates(frame(spark, pages), shingle=1, percent=85, leaf=64).collect())
    assert [got[2 * k + 1]["component_id"] for k in range(60)] == [2 * k for k in range(60)]
    assert sum(r["kept"] for r in got.values()) == 1940


@pytest.mark.parametrize("percent", [45, 67, 80, 85, 99, 100])
def test_similar_sets_share_a_prefix_id(percent):
    rng = np.random.default_rng(percent)
    spread = rng.integers(0, 5, chosen_path.BUCKETS)
    met = 0
    for _ in range(400):
        base = rng.choice(5000, rng.integers(1, 40), replace=False).astype(np.uint64)
        other = base.copy()
        for at in rng.integers(0, len(base), rng.integers(0, 1 + len(base) // 3)):
            other[at] = rng.integers(5000, 9000)
        a, b = np.unique(base), np.unique(other)
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= percent * (len(a) + len(b) - shared):
            met += 1
            prefixes = [chosen_path.prefix_of(x, spread, percent) for x in (a, b)]
            assert len(np.intersect1d(*prefixes))
    assert met > 20
    with pytest.raises(ValueError, match="45 to 100"):
        chosen_path.near_duplicates(None, percent=44)


@pytest.mark.parametrize("percent", range(45, 101))
@pytest.mark.parametrize("trees, depth", [(16, 12), (1, 12), (30, 3)])
def test_trees_keep_the_bound(percent, trees, depth):
    trees, depth = chosen_path.tree_plan(percent, trees, depth)
    assert (1 - (percent / 100) ** depth) ** trees <= chosen_path.MISS
    used = [token for t in range(trees) for token in chosen_path._path(t, depth)]
    assert len(used) == len(set(used)) == trees * depth


@pytest.mark.parametrize("block_bytes", [1 << 24, 1 << 10])
def test_blocks_hold_every_unconnected_pair(spark, block_bytes):
    component = [0] * 30 + [30 + i // 2 for i in range(30)] + [100] * 3
    rows = [(int(i >= 60), i, c, 8) for i, c in enumerate(component)]
    members = spark.createDataFrame(rows, "cluster long, rep long, component long, n long")
    groups = collections.defaultdict(list)
    for r in chosen_path._block_pairs(members, 8, block_bytes).collect():
        groups[r["node"]].append((r["block"], r["rep"]))
    met = set()
    for group in groups.values():
        assert len({b for b, _ in group}) <= 2
        split = len({b for b, _ in group}) == 2
        met |= {(x, y) for a, x in group for b, y in group if x < y and (a != b or not split)}
    assert met >= {(x, y) for y in range(60) for x in range(y) if component[x] != component[y]}
    assert all(x < 60 and y < 60 for x, y in met)


def test_dropping_near_duplicates_keeps_columns(spark, corpus):
    docs = documents(spark, corpus)
    left = chosen_path.drop_near_duplicates(docs, shingle=3, percent=85)
    assert left.columns == docs.columns
    _, label = _components(corpus, 3, 85)
    assert {r[0] for r in left.select("doc_id").collect()} - {None} == {i for i, x in enumerate(label) if i == x}
    assert chosen_path.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_few_links_are_found_among_repeats(spark, staging):
    rng = random.Random(8)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(7, n) for n in range(400, 450)] * 2
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["component"] for r in llm_components.components(links, staging, "few").collect()}
    label = {n: n for a, b in pairs if a != b for n in (a, b)}
    for _ in label:
        for a, b in pairs:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert {tuple(r) for r in llm_components.components(links.limit(0), staging, "none").collect()} == set()


def test_repeated_links_take_no_shuffle_of_their_own(spark, staging):
    links = staging.write(spark.createDataFrame([(3, 1), (3, 1), (5, 3)], "a long, b long"), "repeated")
    step = llm_components._round(links)
    assert sorted(map(tuple, step.collect())) == [(3, 1), (5, 1)]
    plan = step._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert grouped and all("min(" in line for line in grouped)  # the least neighbours only


def stored_names(staging, monkeypatch):
    names, write = [], staging.write
    monkeypatch.setattr(staging, "write", lambda df, name: names.append(name) or write(df, name))
    return names


def test_stars_are_components_without_a_round(spark, staging, monkeypatch):
    names = stored_names(staging, monkeypatch)
    links = spark.createDataFrame([(1, n) for n in range(2, 9)] + [(12, 11), (11, 12)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links, staging, "stars").collect()}
    assert got == {n: 1 for n in range(1, 9)} | {11: 11, 12: 11}
    assert names == ["stars-0", "stars-1-least"]


@pytest.mark.parametrize("most", [llm_components.BROADCAST_BYTES, 0])
def test_components_by_broadcast_and_by_shuffle(spark, staging, monkeypatch, most):
    monkeypatch.setattr(llm_components, "BROADCAST_BYTES", most)
    names = stored_names(staging, monkeypatch)
    chain = [(n, n + 1) if n % 3 else (n + 1, n) for n in range(20, 50)]
    links = spark.createDataFrame([*chain, (70, 60), (60, 80), (5, 80), (None, 20), (20, 20)], "a long, b long")
    got = sorted(map(tuple, components(links, staging, "mixed").collect()))
    assert got == sorted([(n, 20) for n in range(20, 51)] + [(n, 5) for n in (5, 60, 70, 80)])
    assert any(name.endswith("-moved") for name in names) == bool(most)


def test_clusters_join_groups_unless_they_grow_large(spark, staging):
    """Nodes 90 and 91 share class 2; classes 10 to 15 hang together and are too many for one cluster."""
    groups = [(90, 1), (90, 2), (91, 2), (91, 3), (92, 5), (92, 6), (92, 5), (92, 6)]
    chain = [(100 + n, m) for n in range(10, 15) for m in (n, n + 1)]
    hub = {}
    for node, rep in groups + chain:
        hub[node] = min(rep, hub.get(node, rep))
    rows = spark.createDataFrame([(n, r, hub[n]) for n, r in groups + chain], "node long, rep long, hub long")
    spots, reps = chosen_path._clusters(rows, staging, 4)
    found = sorted((r["node"], r["rep"]) for r in spots.collect())
    assert found == sorted([(1, 1), (1, 2), (1, 3), (5, 5), (5, 6), *chain])
    assert spots.columns == ["node", "rep"]
    assert sorted(r["rep"] for r in reps.collect()) == [1, 2, 3, 5, 6, *range(10, 16)]


def test_components_of_a_long_chain(spark, staging):
    links = spark.createDataFrame([(i, i + 1) for i in range(10, 60)] + [(3, 4), (4, 4)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links, staging).collect()}
    assert got == {i: 10 for i in range(10, 61)} | {3: 3, 4: 3}


@pytest.mark.parametrize("hot", [repeat_index.HOT_CONTEXTS, 3, 0])
def test_repeated_strings_match_brute_force(spark, corpus, hot):
    """Anchors compared in one task, as windows over all tasks, and some of each."""
    got = by_id(repeat_index.repeated_strings(documents(spark, corpus), hot=hot).collect())
    seen = set()
    for i, text in enumerate(corpus):
        data = (text or "").encode()
        gone, own = bytearray(len(data)), set()
        for j in range(len(data) - 49):
            window = data[j : j + 50]
            own.add(window)
            if window in seen:
                gone[j : j + 50] = b"\1" * 50
        seen |= own
        assert got[i]["n_removed"] == sum(gone)
        assert bytes(got[i]["kept"]) == bytes(c for c, g in zip(data, gone) if not g)
        assert sum(s["end"] - s["start"] for s in got[i]["spans"]) == sum(gone)
    assert repeat_index.repeated_strings(documents(spark, corpus).limit(0)).count() == 0


@pytest.mark.parametrize("hot", [repeat_index.HOT_CONTEXTS, 1])
def test_periodic_stretches_match_brute_force(spark, hot):
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz -|="
    texts = []
    for period in (1, 2, 3, 5, 7, 10, 13, 20, 30, 31, 32, 49, 50, 51):
        for _ in range(12):
            unit = "".join(rng.choice(letters) for _ in range(period))
            for _ in range(2):
                phase, length = rng.randrange(period), rng.randrange(50, 260)
                run = (unit * 400)[phase : phase + length]
                sides = ("".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(2))
                texts.append(run.join(sides))
    texts += ["ha " * 900, "-" * 3_000 + "end", "start" + "-" * 2_000]
    got, seen, wrong = by_id(repeat_index.repeated_strings(frame(spark, texts), hot=hot).collect()), set(), []
    for i, text in enumerate(texts):
        data = text.encode()
        gone = bytearray(len(data))
        own = [data[j : j + 50] for j in range(len(data) - 49)]
        for j, window in enumerate(own):
            if window in seen:
                gone[j : j + 50] = b"\1" * 50
        seen.update(own)
        if bytes(got[i]["kept"]) != bytes(c for c, g in zip(data, gone) if not g):
            wrong.append(i)
    assert not wrong


def test_a_periodic_stretch_is_few_anchors():
    with np.errstate(over="ignore"):
        found = repeat_index._anchors([1, 2], [b"-" * 30_000, b"ha " * 10_000], 50, 20)
    assert len(found[0]) < 500


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_match_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcde ") for _ in range(rng.randrange(8, 45))) + "." for _ in range(25)]
    texts = ODD[:6]
    for _ in range(40):
        lines = []
        for line in rng.sample(base, 3):
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(line))
                line = line[:at] + rng.choice(["", "z", line[at] + "y"]) + line[at + 1 :]
            lines.append(line)
        texts.append("\n".join([*lines, "", " "]))
    earlier, expected, links = [], [], []
    known = {x for t in texts for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")}
    near = {
        x: {
            y
            for y in known
            if x != y and abs(len(x) - len(y)) < 3 and _edits(x, y) <= min(2, min(len(x), len(y)) // 10)
        }
        for x in known
    }
    for text in texts:
        kept, count = [], 0
        for line in (text or "").split("\n"):
            if line in known:
                count += len(near[line])
                if line in earlier or near[line] & set(earlier):
                    earlier.append(line)
                    continue
                earlier.append(line)
            kept.append(line)
        expected.append(None if text is None else "\n".join(kept))
        links.append(count)
    got = by_id(line_join.line_report(documents(spark, texts)).collect())
    assert [got[i]["text"] for i in range(len(texts))] == expected
    assert [got[i]["n_links"] for i in range(len(texts))] == links
    assert sum(links) > 20


@pytest.mark.parametrize("per_edit", [2, 5, 10])
def test_short_near_lines_match_brute_force(spark, per_edit):
    """Lines of a few characters, down to one more than the edits they may differ by."""
    rng = random.Random(per_edit)
    lines = {"Read more >", "Read more >>", "ab", "abc", "abd", "", "x"}
    while len(lines) < 120:
        lines.add("".join(rng.choice("ab") for _ in range(rng.randrange(1, 14))))
    docs = frame(spark, sorted(lines))
    got = line_join.duplicate_lines(docs, chars_per_edit=per_edit).collect()
    links = {r["doc_id"]: r["n_links"] for r in got}
    order = [x for x in sorted(lines)]
    for n, x in enumerate(order):
        near = [
            y for y in order
            if x and y and x != y and _edits(x, y) <= min(2, min(len(x), len(y)) // per_edit)
        ]
        assert links.get(n, 0) == len(near), x
    assert sum(links.values()) > 2
    with pytest.raises(ValueError, match="more characters than edits"):
        line_join.duplicate_lines(docs, chars_per_edit=1)


def test_dropping_lines_keeps_columns_and_drops_the_emptied(spark):
    docs = frame(spark, ["a b\nc d", "c d", "e f\na b", None])
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_join.drop_lines(docs).collect()}
    assert out == {0: ("a b\nc d", 7), 2: ("e f", 3), 3: (None, 0)}
    assert line_join.drop_lines(docs).columns == docs.columns
    assert line_join.line_report(docs.limit(0)).count() == 0


def test_packing_round_trip_and_fit(spark, corpus):
    packed = packing.pack(frame(spark, corpus), row_tokens=256, block_tokens=20_000)
    rows = packed.collect()
    assert all(r["n_tokens"] <= 256 == len(r["ids"]) // 2 for r in rows)
    assert all(r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] for r in rows)
    assert all(r["position_resets"] == r["cu_seqlens"][:-1] for r in rows)
    pieces = collections.defaultdict(dict)
    for r in packing.unpack(packed).collect():
        pieces[r["doc_id"]][r["offset"]] = r["ids"]
    codec = packing.encoder(packing.VOCABULARY)
    for i, text in enumerate(corpus):
        ids = [x for _, part in sorted(pieces[i].items()) for x in part]
        assert ids[-1] == packing.END_ID
        assert codec.decode(ids[:-1]) == (text or "")
    assert packing.pack(frame(spark, corpus).limit(0)).count() == 0


def test_best_fit_takes_the_tightest_row():
    rng = random.Random(1)
    lengths = [rng.randrange(1, 65) for _ in range(500)]
    rows = packing.best_fit(lengths, 64)
    assert sorted(i for r in rows for i in r) == list(range(500))
    rooms, plain = [], []
    for i in sorted(range(500), key=lambda i: -lengths[i]):
        fitting = [r for r in range(len(rooms)) if rooms[r] >= lengths[i]]
        if fitting:
            best = min(fitting, key=lambda r: rooms[r])
            rooms[best] -= lengths[i]
        else:
            rooms.append(64 - lengths[i])
        plain.append(i)
    assert sorted(64 - sum(lengths[i] for i in r) for r in rows) == sorted(rooms)


def test_quality_on_the_held_out_fold(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(docs, labels, metadata=("n_chars",))
    scored = with_quality(docs, model).join(labels, "doc_id")
    held = scored.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    right = held.where((F.col("score") >= 0.7) == (F.col("quality") == 1)).count()
    assert right / held.count() > 0.95
    odd = frame(spark, ODD)
    assert with_quality(odd, model, score="score_").where("score_ between 0 and 1").count() == len(ODD)
    assert keep_quality(odd, model).columns == odd.columns
    assert with_quality(odd.limit(0), model, score="score_").count() == 0


def test_quality_is_the_sum_over_all_pairs(spark):
    docs = frame(spark, ["good words here", "bad ### ### ###", None, "more good words"])
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, None), (3, 1), (9, 1)], "doc_id long, quality int")
    model = fit_quality(docs, labels)
    index, value = np.array([1, 5, 9]), np.array([0.5, 1.0, 2.0])
    linear = model.bias + model.weights[index] @ value
    pairs = sum(
        model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j] for i in range(3) for j in range(i)
    )
    assert model.score(index, value) == pytest.approx(1 / (1 + np.exp(-linear - pairs)))
    none = fit_quality(docs, labels.limit(0))
    assert {r[0] for r in with_quality(docs, none, score="s").select("s").collect()} == {0.5}
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")

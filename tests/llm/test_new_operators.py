"""Line dedup, conversation repair and the Merkle manifest against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import lines, merkle, repair
from strata.session import setting

SPACE = " \t\n\x0b\x0c\r"


def lower(s):
    return s.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# line dedup

def plain_lines(rows):
    key = lambda line: lower(line.strip(SPACE))
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        kept = [x for x in own if len(holders[key(x)]) < 5 or i == max(j for j in holders[key(x)] if j is not None)]
        out.append((i, len(own), len(own) - len(kept), sha("\n".join(kept))))
    return out


@pytest.fixture(scope="module")
def line_rows():
    rng = random.Random(5)
    pool = ["A shared line of the site, number %d, that is long enough" % k for k in range(30)]
    pool += ["Zürich é çà línea compartida número %d más larga" % k for k in range(5)] + ["short one", "é" * 39, "é" * 40, ""]
    rows = []
    for i in range(60):
        own = [rng.choice(["", " ", "\t", " "]) + (x.upper() if rng.random() < .1 and x.isascii() else x) + rng.choice(["", "\r", "  "])
               for x in rng.choices(pool, k=rng.randint(0, 12))] + [f"only here {i} " * 5] * (i % 3)
        rows.append((i, "\n".join(own)))
    rows += [(7, rows[7][1]), (8, rows[9][1]), (None, "\n".join(pool)), (None, pool[0]), (100, None), (101, ""),
             (102, "\n\n"), (103, pool[3] * 20_000 + "\n" + pool[4]), (104, "\n".join(pool[:3] * 4000))]
    return rows


def test_line_dedup_equals_brute_force(spark, line_rows, tmp_path):
    docs = spark.createDataFrame([(t, i, "x", 1, b"y") for i, t in line_rows],
                                 "text string, doc_id long, a string, n long, last binary")
    got = lines.digests(lines.dedup_lines(docs, str(tmp_path / "one")))
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(plain_lines(line_rows), key=order)
    assert lines.dedup_lines(docs.limit(0), str(tmp_path / "none")).count() == 0


def test_line_dedup_over_many_files_and_shards(spark, line_rows, tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "FILE_KEYS", 5)
    monkeypatch.setattr(lines, "SHARD_KEYS", 2)
    docs = spark.createDataFrame(line_rows, "doc_id long, text string").repartition(7)
    rows = lines.id_text(docs)
    index = lines.build_index(rows, str(tmp_path))
    assert index["files"] > 1 and index["per_file"] > 1
    kept = lines.digests(lines.drop_repeated(rows, index))
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, kept.collect()), key=order) == sorted(plain_lines(line_rows), key=order)
    with pytest.raises(ValueError):
        lines.drop_repeated(rows, index, min_docs=1)


def test_perfect_hash_is_minimal_and_rejects_strangers(tmp_path):
    rng = np.random.default_rng(1)
    pairs = rng.integers(-2**63, 2**63 - 1, (50_000, 2), dtype=np.int64)
    shard = pairs[:, 0] % 4
    file = lines.IndexFile(0)
    for s in range(4):
        own = pairs[shard == s]
        levels, slot = lines.perfect_hash(own[:, 0].view(np.uint64).copy(), own[:, 1].view(np.uint64).copy())
        assert sorted(slot.tolist()) == list(range(len(own)))
        file.add(s, own[:, 0].copy().view(np.uint64), own[:, 1].copy().view(np.uint64), np.arange(len(own)) + 2, np.arange(len(own)))
    wrote = file.write(str(tmp_path), 4)
    assert wrote["n_keys"] == len(pairs)
    probe = lines.Probe({"folder": str(tmp_path), "files": 1, "per_file": 4, "bytes": {0: wrote["bytes"]}})
    n, last = probe.find(pairs)
    for s in range(4):
        assert (last[shard == s] == np.arange((shard == s).sum())).all()
    assert (n >= 2).all()
    strangers = np.column_stack([pairs[:, 0], pairs[:, 1] ^ 1])
    assert not probe.find(strangers)[0].any() and len(probe.find(pairs[:0])[0]) == 0


# conversation repair

def plain_rows(rows):
    """The contract's damage, in the order of the turns."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        s = lambda x: " " if x is None else str(x)
        own, fault = by[conv], zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        role, text = s(role), s(text)
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        own += [(turn is not None, turn, role, hashlib.sha256(text.encode()).digest(), text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return {c: [(x[1], x[2], x[4]) for x in sorted(r)] for c, r in by.items()}


def plain_repair(rows):
    seen, kinds, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        kind = ("blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else
                "truncated" if text.rstrip(SPACE)[-1] not in ".!?" else "")
        seen.add((role, text))
        kinds.append(kind)
        if kind:
            count[kind] += 1
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))

    # (state, edits, repaired rows) -> cost, thinned to the least of each state behind every row
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    ways = {("", "", ()): 0}
    for (turn, role, text), kind in zip(rows, kinds):
        ways = spread(ways, due)
        new = {}
        for (state, edits, out), cost in ways.items():
            add(new, (state, edits + "D", out), cost + 3)
            if kind in ("blank", "duplicate"):
                continue
            more = kind == "truncated"
            c = role[:1]
            if c == due[state] or c == "s" and state == "":
                add(new, (c, edits + "K", (*out, f"{role}:{text}")), cost + more)
            full = {"u": "user", "a": "assistant"}[due[state]]
            add(new, (due[state], edits + "R", (*out, f"{full}:{text}")), cost + 2 + more)
        ways = thin(new)
    ways = spread(ways, due)
    cost, edits, out = min((c, e, o) for (s, e, o), c in ways.items() if s in ("", "a"))
    return (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, edits, sha("\n".join(out)))


def add(table, key, cost):
    table[key] = min(cost, table.get(key, 1 << 30))


def spread(ways, due):
    """With up to four insertions behind each way."""
    out, edge = dict(ways), dict(ways)
    for _ in range(4):
        edge = {(due[s], e + "I", (*o, {"u": "user:", "a": "assistant:"}[due[s]])): c + 2 for (s, e, o), c in edge.items()}
        out.update(edge)
    return out


def thin(ways):
    """The least (cost, edits) of each state: all ways end with the edit of the same row."""
    best = {}
    for (s, e, o), c in ways.items():
        if s not in best or (c, e) < best[s][:2]:
            best[s] = (c, e, o)
    return {(s, e, o): c for s, (c, e, o) in best.items()}


def conversations(rng, n, length):
    rows = []
    texts = ["Yes.", "No!", "what", "Go on?", " ", "", "half a", "Fine. ", "é…", None]
    for c in range(n):
        for t in range(rng.randint(0, length)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u", "User"])
            rows.append((c, rng.choice([t, t, t, t + 3, None, max(0, t - 1)]), role,
                         rng.choice(texts) if rng.random() < .6 else f"text {rng.random()}."))
    return rows


def check_repair(spark, rows, partitions=4):
    frame = spark.createDataFrame([(*r, "clash", 9) for r in rows], "conv_id long, turn long, role string, text string, "
                                                                "h string, copies int").repartition(partitions)
    got = {r[0]: tuple(r[1:]) for r in repair.repair(repair.damage(frame)).collect()}
    damaged = plain_rows(rows)
    assert got == {c: plain_repair(r) for c, r in damaged.items()}
    return got


def test_repair_equals_brute_force(spark):
    rows = conversations(random.Random(11), 400, 9)
    rows += [(None, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(7)] + [(None, None, None, None)] * 3
    rows += [(900, None, "system", "Be nice.")] * 5 + [(901, 0, "user", "x" * 300_000 + "."), (901, 1, "assistant", "y")]
    got = check_repair(spark, rows)
    assert any(not r[6] for r in got.values())           # a conversation that lost all its rows
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(repair.damage(empty)).count() == 0


def test_repair_of_long_conversations_in_many_tasks(spark, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(repair, "BLOCK", 4)
    rows = [(5, t if t % 50 else None, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"n{t}", f"m{t}!"])) for t in range(900)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in (1, 2, 3, 4, 6, 7) for t in range(20)]
    before = check_repair(spark, rows)
    monkeypatch.setattr(repair, "HELD", 2)
    assert check_repair(spark, rows, 9) == before


def test_search_between_states_gives_the_least_edits():
    rng = random.Random(4)
    for _ in range(300):
        free = [repair.Row(0, rng.choice(["user", "assistant", "system", "x", ""]), "t", rng.random() < .3) for _ in range(rng.randint(0, 6))]
        whole = repair.search(free, repair.START, None)
        cut = rng.randint(0, len(free))
        blocks = [repair.Block(repair.Facts(), part).searched() for part in (free[:cut], free[cut:])]
        got = repair.put_together(iter(blocks))
        assert (got[5], got[6]) == whole


# Merkle manifest

def plain_merkle(rows, fan):
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    h = lambda *parts: sha("".join(parts))
    leaf = lambda r: h(*map(field, r))

    def tree(nodes):
        """Root, and for each node its proof as (left, right) pairs."""
        proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
        while len(level) > 1:
            for k in range(len(nodes)):
                run = at[k] // fan * fan
                proofs[k].append(("".join(level[run:at[k]]), "".join(level[at[k] + 1:run + fan])))
                at[k] //= fan
            level = [h(*level[k:k + fan]) for k in range(0, len(level), fan)]
        return level[0], proofs

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    members = [sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources]
    trees = [tree([leaf(r) for r in m]) for m in members]
    root, above = tree([t[0] for t in trees])
    out = []
    for m, (sub, proofs), top in zip(members, trees, above):
        for r, p in zip(m, proofs):
            p, own = p + top, leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                own = leaf((*r[:4], None if r[4] is None else lower(r[4])))
            for left, right in p:
                own = h(left, own, right)
            out.append((r[0], leaf(r), sub, root, h(*(a + b for a, b in p)), own, own == root))
    return out


def merkle_rows():
    rng = random.Random(9)
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", "Ärger", "", None, "z"]), rng.choice(["en", None]), rng.choice([None, i]),
             rng.choice([None, "", "Text A", "lower only", "ÉÀ Z"])) for i in range(400)]
    rows += [(1000, "lone", "en", 3, "ABC"), (5, "hot", "en", 1, "Again"), (None, "hot", None, None, "No id"), (None, None, None, None, None)]
    return rows + [(2000, "copies", "en", 1, "The same")] * 300 + [(3, "long", "en", 1, "Long " * 100_000)]


@pytest.mark.parametrize("fan", [16, 3])
def test_merkle_proofs_equal_brute_force(spark, fan):
    rows = merkle_rows()
    frame = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "doc_id long, source string, lang string, n_chars long, "
                                  "text string, leaf string, rank long, tree long").repartition(5)
    got = merkle.verified(frame, fan=fan)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(plain_merkle(rows, fan), key=order)


def test_merkle_of_one_row_and_of_none(spark):
    frame = spark.createDataFrame([(5, "s", "en", 1, "One")], "doc_id long, source string, lang string, n_chars long, text string")
    (r,) = merkle.verified(frame).collect()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == sha("")
    assert r.verified == (zlib.crc32(b"5") % 5 != 0)
    assert merkle.verified(frame.limit(0)).count() == 0


def test_merkle_sends_no_leaves_and_no_requests_through_the_driver(spark):
    n = 60_000
    frame = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 9 > 0, "s").alias("source"), F.lit("en").alias("lang"),
                                  F.col("id").alias("n_chars"), F.lit("Text").alias("text"))
    with setting(spark, "spark.sql.maxBroadcastTableSize", "8m"):        # a broadcast of more is refused
        got = merkle.verified(frame).agg(F.count("*"), F.countDistinct("leaf"), F.countDistinct("subroot"), F.countDistinct("root"),
                                          F.sum((F.col("verified") == (F.crc32(F.col("doc_id").cast("string")) % 5 != 0)).cast("int"))).first()
    assert tuple(got) == (n, n, 2, 1, n)


def test_components_of_a_hub_and_of_a_chain(spark):
    from strata.llm.graph import components, with_least

    hub = [(k, 7) if k % 2 else (7, k) for k in range(100, 900)]
    chain = [(k, k + 1) for k in range(2000, 2040)]
    edges = spark.createDataFrame(hub + chain + [(5000, 5000), (2, 3), (2, 3)], "u long, v long")
    found = {r.vertex: r.component for r in components(edges).collect()}
    assert found == {7: 7, **{k: 7 for k in range(100, 900)}, **{k: 2000 for k in range(2000, 2041)}, 2: 2, 3: 2}

    rows = spark.createDataFrame([("a", k, "x") for k in range(300)] + [("b", 5, "y"), ("b", 5, "y"), (None, 1, "z")],
                                 "k string, v long, other string")
    got = with_least(rows, "k", "v", "m").collect()
    assert len(got) == 302 and {(r.k, r.m) for r in got} == {("a", 0), ("b", 5)}
    assert with_least(rows.limit(0), "k", "v", "m").count() == 0
    assert components(edges.limit(0)).count() == 0

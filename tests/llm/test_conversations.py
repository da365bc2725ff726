"""Prefix trie, conversation repair and benchmark decontamination against brute force, edge cases included."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ranklift.llm import decontam, prefix_trie, repair

CHAT = "conv_id long, turn long, role string, text string, node long, depth long, key string, place long, n1 long, letter string"
DOCS = "doc_id long, text string, spans string, items string, key string, n_words long, m int"


def chats(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k", 3, 4, "l") for r in rows], CHAT).repartition(3)


def order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, (role or "").encode(), (text or "").encode())


# prefix trie

def trie(rows):
    """The contract, by dictionaries."""
    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own[r[0]].append((r[2] or "", r[3] or ""))
    full = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 9, c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        full[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    group = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            group[turns[:d]].append(c)
    children = Counter(p[:-1] for p in group if p)
    out = []
    for p, cs in group.items():
        below = [q for q in group if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in cs if full[c] == p))
        out.append((min(cs), len(p), min(group[p[:-1]]) if p else None, len(cs), children[p], sum(not children[q] for q in below),
                    sum((len(group[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def chat_rows(seed, convs=23):
    r = random.Random(seed)
    rows = []
    for c in [*range(convs), -3, -5, -8, 105, 107]:
        for t in range(r.choice([0, 1, 2, 3, 5, 12])):
            rows.append((c, t, r.choice(["user", "assistant"]), f"text {r.randrange(2)} été {t // 2}"))
    rows += [(5, None, "user", "null turn"), (6, 1, None, None), (6, 1, "", ""), (6, 1, "", ""), (None, 0, "user", "no id"), (7, 2, "user", "x" * 50_000)]
    rows += rows[:4] + [(10 + 5 * k, t, "user", f"same {t}") for k in range(8) for t in range(100, 104)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_prefix_trie_against_brute_force(spark, seed):
    rows = chat_rows(seed)
    got = [tuple(r) for r in prefix_trie.prefix_trie(chats(spark, rows)).collect()]
    assert sorted(got, key=str) == trie(rows)


def test_trie_of_one_long_conversation_spread_over_ranges(spark):
    rows = [(10, t, "user", f"turn {t % 7}") for t in range(700)] + [(11, t, "user", "b") for t in range(4)]
    got = prefix_trie.prefix_trie(chats(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie(rows)
    parts = prefix_trie.stored_turns(chats(spark, rows), 12345).filter("conv_id = 10").collect()
    h = 1
    for k, p in enumerate(sorted(parts, key=lambda p: p.k), 1):
        h = (h * 12345 + ((p.t1 << 64) | (p.t2 % 2 ** 64))) % prefix_trie.PRIME
        assert p.k == k and ((p.h1 << 64) | (p.h2 % 2 ** 64)) == h


def test_deep_paths_are_summed_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "DEPTH_BITS", 2)
    monkeypatch.setattr(prefix_trie, "ID_BLOCK", 3)
    rows = chat_rows(3)
    assert sorted((tuple(r) for r in prefix_trie.prefix_trie(chats(spark, rows)).collect()), key=str) == trie(rows)


def test_groups_that_disagree_are_seen(spark):
    rows = spark.createDataFrame([(1, 1, 7, 7, 0, 1, 5, 5, 3, True), (2, 1, 7, 7, 0, 1, 5, 6, 3, True)], prefix_trie._MEMBER)
    assert [r.whole for r in prefix_trie._nodes(rows).collect()] == [False]
    with pytest.raises(RuntimeError):
        prefix_trie.prefix_trie(chats(spark, [(1, 0, "user", "a")]), tries=0)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(chats(spark, [])).count() == 0
    assert prefix_trie.prefix_trie(chats(spark, [(None, 0, "user", "a")])).count() == 0


# repair

SPACE = " \t\n\v\f\r"


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        kept = text.rstrip(SPACE)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(turns):
    """(cost, letters, repaired turns) over all edit sequences, by a plain search that keeps the least per state."""
    def push(states, q, new):
        if q not in states or new[:2] < states[q][:2]:
            states[q] = new
    def inserts(states):
        for _ in range(4):
            for q, (c, a, t) in list(states.items()):
                role = "assistant" if q == 2 else "user"
                push(states, 3 if q == 2 else 2, (c + 5, a + "I", [*t, (role, "")]))
        return states
    states = inserts({0: (0, "", [])})
    for (role, text), f in zip(turns, faults(turns), strict=True):
        after = {}
        for q, (c, a, t) in states.items():
            push(after, q, (c + 2, a + "D", t))
            if f in ("blank", "duplicate"):
                continue
            extra = 5 if f else 0
            if role[:1] and (q, role[:1]) in {(0, "s"): 1, (0, "u"): 1, (1, "u"): 1, (3, "u"): 1, (2, "a"): 1}:
                push(after, {"s": 1, "u": 2, "a": 3}[role[0]], (c + extra, a + "K", [*t, (role, text)]))
            new = "assistant" if q == 2 else "user"
            push(after, 3 if q == 2 else 2, (c + extra + 1, a + "R", [*t, (new, text)]))
        states = inserts(after)
    return min((states[q][:2], states[q][2]) for q in (0, 3) if q in states)


def repaired(rows):
    def text(x):
        return " " if x is None else str(x)
    by = defaultdict(list)
    for c, turn, role, body in rows:
        by[c]
        fault = zlib.crc32(f"{text(c)}:{text(turn)}".encode()) % 20
        role, body = text(role), text(body)
        if fault:
            new = "" if fault == 1 else re.sub("[.!?]", "", body) if fault == 2 else body
            by[c] += [(c, turn, "user" if fault == 4 else role, new)] * (2 if fault == 3 else 1)
    out = []
    for c, own in by.items():
        own.sort(key=order)
        turns = [r[2:] for r in own]
        at = {r[1] for r in own if r[1] is not None}
        n = Counter(faults(turns))
        (cost, audit), fixed = cheapest(turns)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in fixed))
        illegal = sum((a[0][:1], b[0][:1]) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in itertools.pairwise(turns))
        out.append((c, max(at) - min(at) + 1 - len(at) if at else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
    return sorted(out, key=str)


def broken_rows(seed):
    r = random.Random(seed)
    texts = ["Fine.", "Also fine!", "cut off", "", "  \n", "Why? ", "été.", None]
    rows = [(c, t * r.choice([1, 1, 1, 2]), r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]), r.choice(texts))
            for c in [*range(40), -4] for t in range(r.randrange(9))]
    return rows + rows[:6] + [(None, 0, "user", "Hi."), (None, None, "assistant", "Ho."), (50, None, "user", "z" * 100_000 + "."), (51, 9, "assistant", "Alone.")]


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_against_brute_force(spark, seed):
    rows = broken_rows(seed)
    table = chats(spark, rows)
    got = [tuple(r) for r in repair.repair(repair.damage(table), table).collect()]
    assert sorted(got, key=str) == repaired(rows)


def test_auction_prices_and_least_letters():
    r = random.Random(5)
    initial = {0: "s", 1: "u", 2: "a", 3: "x"}
    text = {0: "Fine {}.", 1: "", 3: "cut {}"}
    for _ in range(400):
        sorts = [(r.choice([0, 1, 1, 2, 2, 3]), r.choice([0, 0, 0, 1, 3])) for _ in range(r.randrange(12))]
        turns = [(initial[i], text[f].format(k)) for k, (i, f) in enumerate(sorts)]
        (cost, audit), fixed = cheapest(turns)
        found = repair.auction("".join(chr(65 + 4 * i + f) for i, f in sorts))
        assert found[:2] == (cost, audit)
        assert [x for x in found[2] if x != "-"] == [role[:1] for role, _ in fixed]


def test_auction_takes_steps_in_proportion_to_the_turns():
    assert repair.auction("EI" * 20_000 + "N" * 2)[0] == 4


def test_repair_of_one_long_conversation_and_of_nothing(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 16)
    rows = [(3, t, "user" if t % 3 else "assistant", f"Turn {t % 90}.") for t in range(600)]
    table = chats(spark, rows)
    assert sorted((tuple(r) for r in repair.repair(repair.damage(table), table).collect()), key=str) == repaired(rows)
    none = chats(spark, [])
    assert repair.repair(repair.damage(none), none).count() == 0


# decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def hits(docs, items):
    grams = defaultdict(set)
    for item, t in items:
        w = WORD.findall(lower(t))
        m = min(10, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            grams[tuple(w[k:k + m])].add(item)
    out = []
    for d, t in docs:
        w = WORD.findall(lower(t))
        hit, own = set(), set()
        for m in {len(g) for g in grams}:
            for k in range(len(w) - m + 1):
                if (g := tuple(w[k:k + m])) in grams:
                    hit |= set(range(k, k + m))
                    own |= grams[g]
        ids = ",".join(sorted(str(x) for x in own if x is not None))
        out.append((d, len(w), len(hit), len(own - {None}), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def leaky(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "B", "été", "zusammengesetzt", "zusammengesetzte", "x1", "Straße", "same"]) + r.choice(["", "", "s"])
    items = [(k, " ".join(word() for _ in range(r.choice([0, 1, 3, 9, 10, 14, 30])))) for k in range(12)]
    items += [(3, items[0][1]), (None, items[5][1]), (20, None), (21, "..."), (22, "same " * 15), (23, "rare-longerword1 rare")]
    docs = [(k, r.choice([" ", "\n", ", ", "--"]).join([word() for _ in range(r.randrange(40))] + [r.choice(items)[1] or ""]
                                                      + [word() for _ in range(r.randrange(9))])) for k in range(60)]
    docs += [(None, docs[0][1]), (7, docs[1][1]), (7, None), (80, ""), (81, " .,; "), (82, "same " * 3000), (83, "RARE longerword1 rare longerword2 rare")]
    return docs + docs[:3], items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_contamination_against_brute_force(spark, seed):
    docs, items = leaky(seed)
    frame = spark.createDataFrame([(d, t, "s", "i", "k", 1, 2) for d, t in docs], DOCS).repartition(3)
    bench = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in items], "item_id long, text string, window string, m int, items int")
    want = hits(docs, items)
    for limit in (decontam.LIMIT, 2000):  # one pass, then several
        assert sorted((tuple(r) for r in decontam.contamination(frame, bench, limit=limit).collect()), key=str) == want


def test_long_text_is_searched_in_overlapping_pieces(monkeypatch):
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(decontam, "PIECE", 300)
    monkeypatch.setattr(decontam, "STRETCH", 16)
    r = random.Random(4)
    word = lambda: r.choice("abcdefgh") + r.choice("ij")
    texts = [" ".join(word() for _ in range(n)) for n in (900, 5, 0, 2000)]
    windows = [" ".join(word() for _ in range(10)) for _ in range(5)]
    for k in range(0, 850, 31):
        parts = texts[0].split(" ")
        parts[k:k + 10] = windows[k % 5].split(" ")
        texts[0] = " ".join(parts)
    windows.append(" ".join(texts[3].split(" ")[990:1000]))
    items = list(enumerate(windows))
    table = decontam._tables([(w.encode(), 10, [i]) for i, w in items])

    class Sent:
        value = table
    monkeypatch.setattr(decontam, "text_slices", lambda t: decontam_slices(t))
    from ranklift.llm.words import text_slices
    decontam_slices = lambda t: text_slices(t, 100)
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2, 3]), pa.array(texts)], names=["doc_id", "text"])
    (out,) = decontam._search(Sent)([batch])
    want = {d: (n, h) for d, n, h, *_ in hits(list(enumerate(texts)), items)}
    for d, n, spans in zip(*(out.column(c).to_pylist() for c in ("doc_id", "n_words", "spans")), strict=True):
        assert (n, sum(s["stop"] - s["begin"] for s in spans)) == want[d]
    assert np.all([len(t.code) for t in table])


def test_contamination_of_and_by_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in decontam.contamination(docs, none).collect()] == [(1, 3, 0, 0)]
    assert decontam.contamination(docs.filter(F.lit(False)), none).count() == 0

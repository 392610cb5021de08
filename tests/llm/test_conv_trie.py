"""The conversation trie against a dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from eventlens.llm import conv_trie, queries
from tests.conftest import SMALL

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuild(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = []
    for path, cs in members.items():
        under = [p for p in members if p[: len(path)] == path]
        kids = lambda p: [q for q in members if len(q) == len(p) + 1 and q[: len(p)] == p]  # noqa: B023, E731
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(path))
        rows.append((
            min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), len(kids(path)), sum(not kids(p) for p in under),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def collected(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf_dir", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    assert collected(queries.QUERIES["op12_prefix_trie"](spark, sf_dir)) == brute(rebuild(rows))


@pytest.mark.parametrize("container, long, bursts", [(20_000, 50_000, 40), (3, 50_000, 40), (0, 0, 40), (6, 4, 2)])
def test_hot_odd_and_long_conversations(spark, rng, monkeypatch, container, long, bursts):
    for name, value in (("CONTAINER", container), ("LONG", long), ("BURSTS", bursts)):
        monkeypatch.setattr(conv_trie, name, value)
    says = ["hi", "é\U0001f600", "", None]
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(says)) for c in range(90, 130) for t in range(rng.randrange(4))]
    rows += [(c, t, "user", f"step {t}") for c in (*range(200, 215), 300) for t in range(7)]  # copies
    rows += [(c, t, "user", f"step {t}") for c in range(400, 412) for t in range(c - 399)]  # each one turn longer
    rows += [(-5, 1, "user", "x"), (-5, 1, "user", "x"), (-5, None, "user", "first"), (None, 1, "user", "nobody"), (0, 3, None, None)]
    rows += [(777, t, "user", "again") for t in range(30)]  # much longer than all others
    rows += [(700, t, "user", "again") for t in range(12)]
    convs = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, depth string")
    got = conv_trie.trie(*queries.rebuilt(conv_trie.ordered_turns(convs)))
    names = dict(zip(("conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends"), COLUMNS, strict=True))
    assert collected(got.withColumnsRenamed(names)) == brute(rebuild(rows))
    assert conv_trie.trie(*queries.rebuilt(conv_trie.ordered_turns(convs.limit(0)))).count() == 0

import hashlib
import random
import zlib

import pytest
import xxhash

from sensorloom.llm import prefix_trie
from tests.llm.samples import rows_of, sentence

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, k1 int, n_convs int"


def _tie(role: str, text: str) -> int:
    value = xxhash.xxh64(text.encode(), seed=xxhash.xxh64(role.encode(), seed=42).intdigest()).intdigest()
    return value - (1 << 64) if value >= 1 << 63 else value


def brute_force(rows: list[tuple]) -> list[tuple]:
    """Every prefix of every rebuilt conversation, taken one by one."""
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0, _tie(role, text)), role, text))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    members: dict[tuple, list[int]] = {}
    lengths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole = tuple(own.get(base, [])[:h] + turns[h:])
        lengths[c] = len(whole)
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
    children: dict[tuple, int] = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    found = []
    for node, ids in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = ",".join(str(c) for c in sorted(c for c in ids if lengths[c] == len(node)))
        found.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), children.get(node, 0),
            sum(n not in children for n in below), sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
            hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def check(spark, rows: list[tuple]) -> None:
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    found = prefix_trie.trie(table).drop("last_chars")
    assert rows_of(found) == brute_force(rows)


def sample() -> list[tuple]:
    pick = random.Random(4)
    rows = []
    for c in [*range(0, 30), *range(100, 130), *range(205, 215), -3, -100, -101]:
        for turn in range(pick.randrange(1, 9)):
            rows.append((c, turn, pick.choice(["user", "assistant"]), pick.choice(["yes", "no", sentence(turn, 5), "é\U0001f600"])))
    rows += [(40, None, "user", "null first"), (40, 3, None, None), (40, 3, "user", ""), (40, None, None, "b"),
             (41, 7, "user", "tie"), (41, 7, "user", "tie"), (41, 7, "a", "tie"), (None, 1, "user", "no id"),
             (42, 0, "user", "x" * 50_000), (300, 0, "user", "only"), (301, 0, "user", "short"), (302, 0, "s", "t")]
    return rows


def test_trie_as_brute_force(spark):
    check(spark, sample())


@pytest.mark.parametrize("light, band, queue", [(1, 1, 1), (5, 2, 3), (20, 3, 2), (60, 100, 1)])
def test_small_shards_bands_and_spilled_queues(spark, monkeypatch, light, band, queue):
    monkeypatch.setattr(prefix_trie, "LIGHT", light)
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 1)
    monkeypatch.setattr(prefix_trie, "ID_BITS", 2)
    monkeypatch.setattr(prefix_trie.SpillingQueue.__init__, "__defaults__", (queue,))
    check(spark, sample())


def test_one_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LIGHT", 50)
    monkeypatch.setattr(prefix_trie, "BAND", 16)
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 4)
    rows = [(7, t, "user", f"turn {t % 7}") for t in range(200)] + [(8, t, "user", f"turn {t % 7}") for t in range(90)]
    check(spark, rows + [(9, 0, "user", "turn 0")])


def test_empty_table_and_turnless_conversations(spark):
    check(spark, [])
    late = [c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 > 1][:2]
    check(spark, [(c, 0, "user", "gone") for c in late])


def test_queue_gives_all_messages_in_order():
    pick = random.Random(1)
    items = [(-pick.randrange(5), pick.randrange(4), 0, i, -i) for i in range(1000)]
    queue = prefix_trie.SpillingQueue(limit=7)
    for item in items:
        queue.push(item)
    found = []
    for address in sorted({i[:3] for i in items}):
        found += sorted(queue.pop_for(address))
    assert found == sorted(items)
    assert not queue.heap and not queue.heads

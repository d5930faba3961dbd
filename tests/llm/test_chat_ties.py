"""Rows of one turn: by role, then by text, as the SQL counterpart orders them."""

import hashlib
import random

from fleetmart.llm import chat


def test_rows_of_one_turn(spark):
    rng = random.Random(1)
    rows = [(c, rng.choice([0, 0, 1, None]), rng.choice(["user", "assistant", None]), rng.choice(["b", "a", "é", "", None, "ab", "zz top"])) for c in range(12) for _ in range(9)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.turns_sha256 for r in chat.digests(chat.format(table)).collect()}
    for c in range(12):
        own = sorted((t is not None, t or 0, role or "", text or "") for conv, t, role, text in rows if conv == c)
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in own)
        assert got[c] == hashlib.sha256(whole.encode()).hexdigest()

"""The text parser against a plain-Python model of the original parsing rules."""

import random
import re

import pytest

from cartograph.operators.clean import clean_text

VALID = {"pv", "cart", "fav", "buy"}
LONG_MIN, LONG_MAX = -(2 ** 63), 2 ** 63 - 1


def java_trim(s):
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 0x20:
        i += 1
    while j > i and ord(s[j - 1]) <= 0x20:
        j -= 1
    return s[i:j]


def parse_long(s):
    if not re.fullmatch(r"[+-]?[0-9]+", s):
        return None
    v = int(s)
    return v if LONG_MIN <= v <= LONG_MAX else None


def model(line):
    s = java_trim(line)
    if not s:
        return None
    if ("user_id" in s and "timestamp" in s) or s.startswith("user_id") or s.startswith("timestamp"):
        return None
    parts = s.split(",") if "," in s else re.split(r"[ \t\n\x0b\f\r]+", s)
    if len(parts) != 5:
        return None
    bt = java_trim(parts[3])
    if bt not in VALID:
        return None
    nums = [parse_long(java_trim(parts[i])) for i in (0, 1, 2, 4)]
    if any(n is None for n in nums):
        return None
    return (nums[0], nums[1], nums[2], bt, nums[3])


SPECIAL = ["+7", "007", "-0", "1.5", "1e3", "", " ", "\t9", "x", "pv", "buy", "BUY", "cart ",
           " fav", "9223372036854775807", "9223372036854775808", "-9223372036854775808",
           "-9223372036854775809", "\u0663", "1 2", "\uff11\uff12", "1_000", "0x10", "12L",
           "7d", "1.", ".5", "+", "-", "--1", "+-1", "2\x7f", "\x7f3", "4\x85"]
SEPS = [",", " , ", " ", "\t", "  ", ",,", ", "]
PADS = ["", " ", "\t", "\x01", " \x0b", "\x00", "\x7f"]


def random_line(rnd):
    n = rnd.choice([3, 4, 5, 5, 5, 5, 5, 6, 7])
    fs = []
    for _ in range(n):
        r = rnd.random()
        fs.append(str(rnd.randint(-10 ** 6, 10 ** 6)) if r < 0.6 else
                  str(rnd.randint(-10 ** 20, 10 ** 20)) if r < 0.7 else rnd.choice(SPECIAL))
    if rnd.random() < 0.75:
        fs[min(3, n - 1)] = rnd.choice(sorted(VALID))
    pad = rnd.choice(PADS)
    line = pad + rnd.choice(SEPS).join(fs) + pad
    r = rnd.random()
    if r < 0.02:
        return "user_id,item_id,category_id,behavior_type,timestamp"
    if r < 0.04:
        return rnd.choice(["", "   ", "\t\x02"])
    return line


@pytest.mark.parametrize("seed", [1, 2])
def test_parser_matches_model(spark, seed):
    rnd = random.Random(seed)
    batch = [random_line(rnd) for _ in range(2000)]
    df = spark.createDataFrame([(x,) for x in batch], "value string")
    got = sorted(tuple(r) for r in clean_text(df).collect())
    want = sorted(m for m in map(model, batch) if m is not None)
    assert len(want) >= 100          # the generator must produce enough valid lines
    assert got == want

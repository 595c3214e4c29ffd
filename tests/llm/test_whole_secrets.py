"""Secrets of any length are hidden whole."""

import random

import pytest

from pathloom.llm import secret_scan

LONG = "".join(random.Random(1).choices("abcdefghijklmnopABCDEFGHXYZ0123456789.", k=800))


@pytest.mark.parametrize("secret", ['password = "correcthorse!battery9staple"', 'credential = "Zk$0123456789abcdef$Qw8xY!pL"', "credential = eyJ" + LONG])
def test_no_part_of_a_secret_stays(secret):
    left = secret_scan.hide(secret, secret_scan.spans(secret))
    assert left.replace("[SECRET]", "").strip('"') in ("", "credential = ", 'credential = "')


def test_long_literals_and_chains():
    long = "q8Zr!2mK#9vLx0T" * 400
    chain = "".join(f"n{i} = n{i + 1}\n" for i in range(2000))
    many = " + ".join(f'"q8Zr!2m{i}"' for i in range(400))
    doubled = "".join(f"d{i} = d{i + 1} + d{i + 1}\n" for i in range(200))
    for text, literal in ((f'secret = "{long}"', long), (f'{chain}n2000 = "{long[:15]}"\nsecret = n0', long[:15]), (f"secret = {many}", "q8Zr!2m399"), (f'{doubled}d200 = "{long[:15]}"\nsecret = d0', long[:15])):
        assert literal in [text[s:e] for s, e in secret_scan.lexed_spans(text)]

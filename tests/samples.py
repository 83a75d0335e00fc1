"""Random but repeatable texts; one Spark job checks many of them."""

import random

ALPHABET = "aZ09 .,-/:$%\\'\"\n\t" + "éÂđọ" + "e\u0301o\u0323\u0302" + "中И٣" + "\u212b"


def joined(pieces, longest, count, separator="", seed=7):
    pick = random.Random(seed)
    return [separator.join(pick.choices(pieces, k=pick.randrange(longest + 1))) for _ in range(count)]


def characters(count, longest=25, alphabet=ALPHABET, seed=11):
    return joined(alphabet, longest, count, seed=seed)

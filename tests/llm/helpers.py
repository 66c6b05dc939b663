"""A messy fixture: nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""

import random
import re

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          "id bigint, key string, row int, class string, size int, bucket int, tie int, part int, node int, a int, b int")


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    return [x for x in re.split("[\x20\x09-\x0d]+", text) if x]


def rows():
    r = random.Random(7)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    base = prose(120)
    passage = prose(90)
    near = base.split(" ")
    near[60] = "changed"
    far = near[:]
    far[20] = far[40] = far[80] = "other"
    texts = [base, base.upper(), " ".join(near), " ".join(far), prose(50) + "\n" + passage, passage + "\n" + prose(70),
             passage, "", None, "   \n\t ", "one", "One two", "one two", "a b c d e", "É é ÉÉ ß", prose(3000),
             "same line here for all of us\n" + prose(30), prose(30) + "\nsame line here for all of us",
             "spam " * 40, "x#y $z & | < >", "tail space  two   three", " line sep", "\x1c odd \x1f"]
    texts += [prose(r.randint(5, 200)) for _ in range(40)]
    out = []
    for i, t in enumerate(texts):
        out.append((i * 3, t, r.choice(["en", "de", None]), r.choice(["s1", "s2", "s10", None]), len(t or ""),
                    7, "k", None, "c", 1, 2, 3, None, 4, 5, 6))
    out += [out[0], out[0], out[6]]                      # repeated rows
    out.append((None, "no id at all but words enough to count", None, None, None, *[None] * 11))
    out.append((500, base, "en", "s1", 3, *[None] * 11))  # the same text under another id
    return out


def messy(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def unique(spark):
    """Without repeated rows and null ids."""
    seen = {}
    for x in rows():
        if x[0] is not None:
            seen.setdefault(x[0], x)
    return spark.createDataFrame(list(seen.values()), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

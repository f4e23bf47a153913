"""Edge cases for the operators over documents."""

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed=0):
    return " ".join(WORDS[(i * i * 7 + i * 3 + seed * 11 + (i * seed) % 13) % len(WORDS)] for i in range(n))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _d int, rep string, c0 string"


def rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows; the
    last columns have names that operators use themselves."""
    out = [(1, prose(60), "en", "a", 10), (2, None, "en", "a", None), (3, "", None, None, 0), (4, "   \n\t ", "de", "b", 3),
           (5, prose(60), "en", "b", 10), (5, prose(60), "en", "b", 10), (None, prose(70, 3), "en", "b", 10),
           (None, None, None, None, None), (6, prose(30_000, 5), "de", "a", 1), (7, "#*$%&|<>", "de", "c", 8),
           (8, "Über straße éà 中文 😀   x\x0by", "fr", "c", 9), (9, prose(61), "en", None, 1), (10, "one two", "en", "a", 1),
           (11, "one two", "en", "a", 1), (12, "\n\n" + "A shared line of well over forty characters, here\n" * 3, "en", "c", 1)]
    out += [(20 + i, f"own {i}\n  a SHARED line of well over forty characters, here \n{prose(60, i)}", "en", "a", 1) for i in range(6)]
    return [(*r, 1, "x", "y") for r in out]

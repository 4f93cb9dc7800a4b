"""Texts and tables that the tests of several operators share."""

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, class string, key long, node long"

WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau "
         "upsilon phi chi psi omega").split()


def prose(seed: int, n: int) -> str:
    """n words that hardly repeat between seeds."""
    return " ".join(f"{WORDS[(seed * 7 + k * 5) % len(WORDS)]}{(seed * 31 + k * k) % 97}" for k in range(n))

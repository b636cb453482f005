import random

import pytest

WORDS = "the quick brown fox jumps over lazy dogs while seven wizards quietly boxed liquor jugs near old stone bridges every warm evening".split()


@pytest.fixture(scope="session")
def odd_texts():
    """Empty, long, special and irregular texts."""
    rng = random.Random(5)
    alphabet = list(" 's'll've're'm'd'tabcÉéßñ 12²½Ⅷ  \n\t\r\x0b\x1c\x85\xa0  .,!?-_€“”İǅſΣσςDžǆ日本😀́é") + ["<|endoftext|>", "<|startoftext|>"]
    return [
        None, "", " ", "\n", "a", "'s", " 's", "don't we'll", "x" * 30_000, "word " * 9_000, "tail  ", "\n \n", "<|endoftext|>a<|endoftext|>",
        *["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(300)],
        *[" ".join(rng.choices(WORDS, k=rng.randint(1, 200))) for _ in range(40)],
    ]

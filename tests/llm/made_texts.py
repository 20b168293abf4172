import random

SYLLABLES = "an er in on re th en sti nd ou ea ha ti es ly ble tion wh of sh".split()


def prose(seed, words):
    """Invented text; the same seed gives the same words."""
    rng = random.Random(seed)
    made = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    lines = [" ".join(made[i:i + 11]).capitalize() + "." for i in range(0, words, 11)]
    return "\n".join(lines)

"""Helpers of the tests beside their fixtures."""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())


def plain_words(text):
    return (text or "").translate(LOWER)


def blanked(text):
    """Words between blanks, as bytes."""
    return plain_words(text).encode().split()

"""Helpers shared by the test modules of the training-data operators."""


def doc(i, text, lang="en", source="s", n=None):
    return (i, text, lang, source, len(text or "") if n is None else n)

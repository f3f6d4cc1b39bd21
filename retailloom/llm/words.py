"""Words of a batch of texts as codes, so that each distinct word is looked at once."""

from __future__ import annotations

import numpy as np
import pandas as pd


def coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(document of each word, code of each word, the distinct words), in the order of the texts."""
    split = [text.split() for text in texts]
    document = np.repeat(np.arange(len(texts)), [len(words) for words in split])
    codes, distinct = pd.factorize(np.array([word for words in split for word in words], dtype=object))
    return document, codes, list(distinct)


def slices(frame: pd.DataFrame, column: str, size: int = 1 << 20):
    """Parts of the frame whose texts have together about ``size`` characters: the bound of a batch's memory."""
    group = frame[column].str.len().cumsum() // size
    for _, part in frame.groupby(group, sort=False):
        yield part

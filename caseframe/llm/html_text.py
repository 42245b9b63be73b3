"""Main text of web pages: a recurrent labeller decides block by block.

A page is a sequence of text blocks. Each block's path of elements and its words
are hashed to vectors, beside its length, share of links, place and signs; a
bidirectional LSTM reads the whole sequence, so every block is judged with all
others in view. The blocks that it wants make up the text.

There are no labelled pages, so the labels come from markup that says what it
is: in pages with an ``article`` or ``main`` element the blocks inside it are
wanted, but for menus, forms, comments and the like in it. At most ``SAMPLE``
such pages of at most ``SAMPLE_CHARS`` characters, chosen by hash, are learnt
from, as they are and with other texts in their blocks, and ``INVENTED`` pages put together from their blocks and from
stock phrases in other layouts, in which class names take the place of the
elements or are missing. Without labelled pages the invented ones remain.

A null page is empty and has the text ``""``; null ids and urls stay; repeated
rows have a row each. An empty table gives no rows, further columns are not read.
"""

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseframe.llm.html_blocks import Block, blocks
from caseframe.llm.html_layouts import invented, reworded
from caseframe.llm.recurrent import DENSE, PATHS, WORDS, Parameters, Sequence, fit, scores
from caseframe.llm.words import chunks

#: Bounds of what is learnt from: labelled pages, their length, and invented pages.
SAMPLE, SAMPLE_CHARS, INVENTED = 200, 40_000, 700
#: Characters of pages that a task reads at a time.
_CHUNK = 1 << 20

# Names of elements and of classes, ids and roles that are not part of an article.
_APART = frozenset("nav aside footer form button select textarea dialog menu label".split())
_APART_NAMES = frozenset(
    f".{name}"
    for name in (
        "ad ads advert adverts advertisement adsbygoogle sponsored promo promoted banner sidebar"
        " widget related recommended comment comments reply replies respond discussion disqus nav"
        " navigation navbar menu breadcrumb breadcrumbs pagination pager share sharing social cookie"
        " cookies consent gdpr notice alert newsletter subscribe subscription signup login search"
        " popup modal overlay copyright footer toolbar hidden"
    ).split()
)
_MAIN = frozenset(["article", "main", ".articlebody"])
_WORD = re.compile(r"\w+")
_CACHE = 200_000


def taught(path: list[str]) -> bool:
    """Whether markup that says what it is takes a block for the article's text."""
    inside = False
    for name in path:
        if name in _MAIN:
            inside = True
        elif inside and (name in _APART or name in _APART_NAMES):
            return False
    return inside and path[0] != "head"


class Features:
    """Blocks as numbers; keeps the numbers of words met."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def _words(self, text: str) -> list[int]:
        known, found = self.known, []
        if len(known) > _CACHE:
            known.clear()
        for word in _WORD.findall(text.lower()):
            number = known.get(word)
            if number is None:
                number = known[word] = crc32(word.encode("utf-8", "replace")) % WORDS
            found.append(number)
        return found

    def sequence(self, page: list[Block]) -> Sequence:
        paths, words, path_ends, word_ends = [], [], [0], [0]
        dense = np.zeros((len(page), DENSE), np.float32)
        for at, block in enumerate(page):
            # The names nearest to the text count for themselves as well.
            names = [*block.path, *(f"{name}<" for name in block.path[-4:])]
            paths += [crc32(name.encode("utf-8", "replace")) % PATHS for name in names]
            own = self._words(block.text)
            words += own
            path_ends.append(len(paths))
            word_ends.append(len(words))
            size = len(block.text)
            signs = sum(map(block.text.count, ".,;:!?"))
            dense[at] = (
                np.log1p(size) / 5,
                np.log1p(len(own)) / 4,
                block.linked / size,
                at / len(page),
                min(1.0, 8 * signs / size),
                block.text[-1] in ".!?\"'",
                "©" in block.text or "(c)" in block.text,
                1,
            )
        return Sequence(
            np.array(paths, np.int64),
            np.array(path_ends, np.int64),
            np.array(words, np.int64),
            np.array(word_ends, np.int64),
            dense,
        )


def _labelled(pages: DataFrame) -> list[tuple[list[Block], np.ndarray]]:
    """A bounded sample of pages whose markup labels their blocks."""
    eligible = pages.filter(F.length("html") <= SAMPLE_CHARS).filter(
        F.lower("html").rlike("<(article|main)[\\s>]|articlebody")
    )
    # Equal pages teach the same, so a page counts once, whatever its place in the table.
    # The numbers are looked for first: only pages that are wanted move.
    numbered = eligible.select(F.xxhash64("html").alias("number"), "html")
    least = numbered.select("number").distinct().orderBy("number").limit(SAMPLE).collect()
    wanted = F.col("number").isin([row["number"] for row in least])
    chosen = numbered.filter(wanted).groupBy("number").agg(F.min("html").alias("html"))
    found = []
    for row in sorted(chosen.collect()):
        page = list(blocks(row["html"]))
        labels = np.array([taught(block.path) for block in page], bool)
        if labels.any() and not labels.all():
            found.append((page, labels))
    return found


def learn(pages: DataFrame, seed: int = 11) -> Parameters:
    """A labeller from the table's own labelled pages and invented ones."""
    labelled = _labelled(pages)
    rounds = max(2, 3 * SAMPLE // max(len(labelled), 1) - 1)
    labelled = [
        *labelled,
        *(page for more in range(rounds) for page in reworded(labelled, seed + more)),
        *invented(labelled, INVENTED, seed),
    ]
    features = Features()
    return fit([features.sequence(page) for page, _ in labelled], [own for _, own in labelled])


def main_texts(model: Parameters, pages: list[str]) -> list[str]:
    """The main text of each page."""
    parsed = [list(blocks(page)) for page in pages]
    features = Features()
    chances = scores(model, [features.sequence(page) for page in parsed])
    return [
        " ".join(block.text for block, chance in zip(page, own, strict=True) if chance >= 0.5)
        for page, own in zip(parsed, chances, strict=True)
    ]


def extract(pages: DataFrame, model: Parameters | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text`` and its length ``n_chars`` of every page."""
    rows = pages.select(
        "page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    learnt = learn(rows) if model is None else model

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, *_ in chunks(batch, "html", _CHUNK):
                found = main_texts(learnt, part.column("html").to_pylist())
                sizes = pa.array([len(text) for text in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(found, pa.string()), sizes],
                    ["page_id", "url", "text", "n_chars"],
                )

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(
        texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )

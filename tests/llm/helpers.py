"""Small tables with the awkward cases every operator must take."""
import random

WORDS = "the of and thon erst inea ould ñas ciónmi ègalé straße über don't we'll it's 12 3.14 — “quoted” end.".split()


def text(seed: int, words: int = 40, line: int = 9) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + ("\n" if k % line == line - 1 else "") for k in range(words))


def awkward_texts() -> list:
    """Null, empty, blank, tiny, odd white space, very long, one long word, copies."""
    base = text(1)
    return [None, "", " ", "\t\n ", "a", "a b", base, base, base.replace(" ", "\t  "), base + " ", text(2), text(3, 30000),
            "x" * 20000, "ab" * 3000 + "'s", "  two  spaces\n\n\nlines \r\n end  ", "<|endoftext|> inside <|endoftext|>",
            "漢字 🙂 é  nbsp　wide\x1cfs ls", "!!!'s 's 'll we've don't ''s '", "123 45a6²½ ª", text(4)]


def documents(spark, texts=None):
    """Documents with ids, a null id, repeated rows and columns whose names clash with
    what operators use inside."""
    texts = awkward_texts() if texts is None else texts
    rows = [(k, t, f"s{k % 3}" if k % 4 else None, "x", 1, 0.5, True) for k, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, texts[6], "s1", "x", 1, 0.5, True)] if len(texts) > 6 else []
    return spark.createDataFrame(rows, "doc_id long, text string, source string, id string, size int, score double, kept boolean")


def empty(spark):
    return documents(spark).limit(0)

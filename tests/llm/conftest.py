import sys
from pathlib import Path

import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"
#: Columns of the operators' own making, to clash with.
CLASH = {"id": 7, "rid": 7, "pos": 7, "n": 7, "part": 7, "queue": 7, "kept": "x", "shard": 7, "slot": 7, "words": "x",
         "keep": "x", "hash": 7, "label": "x", "found": "x"}
LINE = "A line of text that is long enough to be counted as repeated."
PROSE = " ".join(f"word{i} goes on" for i in range(80))


def edge_rows():
    """Null ids and texts, empty and white texts, a very long one, repeated rows, rows that share an id."""
    texts = {1: None, 2: "", 3: " \n\t\n ", 4: LINE, 5: LINE.upper() + "\n" + PROSE, 6: "\x1f".join(["é"] * 60),
             7: PROSE, 8: PROSE, 9: PROSE + " and more", 10: "x " * 30_000 + "\n" + LINE, 11: f"  {LINE} \n{LINE}\nend",
             12: LINE + "\n" + LINE.replace("line", "LINE"), 13: "Released under the MIT License.", 14: "a b c",
             15: "tail <|endoftext|> here  two   spaces \n x", 16: "🙂 " * 70}
    rows = [(i, t, f"s{i % 3}") for i, t in texts.items()]
    rows += [(8, PROSE, "s2"), (14, "another text with the id", None), (None, "no id at all " + PROSE, "s1")]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    frame = pd.DataFrame(edge_rows(), columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    rows = [(None if pd.isna(i) else int(i), t, s, "en", 1, *CLASH.values())
            for i, t, s in frame.itertuples(index=False)]
    kinds = ", ".join(f"{k} {'string' if isinstance(v, str) else 'long'}" for k, v in CLASH.items())
    return spark.createDataFrame(rows, f"doc_id long, text string, source string, lang string, n_chars long, {kinds}")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def documents():
    return pd.read_parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def pages():
    return pd.read_parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

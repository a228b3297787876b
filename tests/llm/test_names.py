"""Extra columns keep their values, whatever they are called."""

import random
import re
from pathlib import Path

import public_tokenizers
import pytest
from helpers import odd_docs

import viewrecon.llm
from viewrecon.llm import bpe, html_extract, line_dedup, mixing, near_dedup, quality_rules, sharding

#: Every name that the operators' code gives a column.
INNER = sorted({x for f in Path(viewrecon.llm.__file__).parent.glob("*.py") for x in re.findall(r'(?:alias|withColumn|explode)\("([A-Za-z_]\w*)"', f.read_text())} | {"in_0", "k__key", "ids", "kept"})
INNER = [x for x in INNER if x not in ("doc_id", "text", "source", "n_chars")]
INNER = [x for i, x in enumerate(INNER) if x.lower() not in {y.lower() for y in INNER[:i]}]


def widened(docs):
    return docs.selectExpr("*", *(f"concat('mine ', coalesce(doc_id, 0), ' {i}') AS `{c}`" for i, c in enumerate(INNER)))


CASES = {
    "mixing": (mixing.mix, ()), "quality": (quality_rules.keep_good, ()), "judge": (quality_rules.judge, quality_rules.RESULTS), "lines": (line_dedup.drop_lines, ()), "near": (near_dedup.drop_near_duplicates, ()),
    "encode": (lambda d: bpe.encode(d, public_tokenizers.path(bpe.VOCABULARY)), ("ids", "offsets")), "checked": (lambda d: bpe.encode_checked(d, public_tokenizers.path(bpe.VOCABULARY)), ("ids", "offsets", "decoded_sha256")),
    "html": (lambda d: html_extract.extract(d, "text"), ()), "place": (sharding.place, ("slot", "shard")),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_extra_columns_keep_their_values(spark, name):
    work, results = CASES[name]
    rng = random.Random(1)
    prose = " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(3, 8))) for _ in range(150)) + "."
    docs = odd_docs(spark).unionByName(spark.createDataFrame([(700 + i, prose[i:]) for i in range(8)], "doc_id long, text string"))
    docs = widened(docs.filter("length(text) < 5000 OR text IS NULL").selectExpr("*", "case when doc_id % 2 = 0 then 'a' end AS source"))
    rows = work(docs).collect()
    assert rows and set(rows[0].asDict()) >= {*INNER, "doc_id"} - {"html"}
    for r in rows:
        for i, c in enumerate(INNER):
            if c not in results:
                assert r[c] == f"mine {r.doc_id or 0} {i}", c

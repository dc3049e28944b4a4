"""python -m kinfold STAGE --out DIR [--s1 FILE --s2 FILE --s3 FILE] [--truth FILE] ..."""

from __future__ import annotations

import argparse
import json
import sys

STAGES = ("normalize", "block", "features", "merge", "train", "tune", "report", "match", "validate", "all")


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="kinfold", description=__doc__)
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--out", required=True, help="folder of the stages' tables")
    for s in ("s1", "s2", "s3"):
        p.add_argument(f"--{s}", help=f"records of source {s[1]}")
    p.add_argument("--truth", help="ground truth of the first source")
    p.add_argument("--matches", help="result file of matches")
    p.add_argument("--candidates", help="result file of candidates")
    p.add_argument("--by", choices=("rules", "model"), default="rules", help="what decides on matches")
    p.add_argument("--iterations", type=int, default=500)
    p.add_argument("--check-ids", action="store_true", help="also look up every id in sources 2 and 3")
    p.add_argument("--clause-aware", action="store_true", help="address cores lose landmark clauses only")
    a = p.parse_args(args)

    from pyspark.sql import SparkSession

    from kinfold.plans import chain

    spark = SparkSession.builder.appName("kinfold").getOrCreate()
    sources = {k.upper(): v for k in ("s1", "s2", "s3") if (v := getattr(a, k))}
    say = lambda x: print(json.dumps(x, default=str))
    wanted = [a.stage] if a.stage != "all" else ["normalize", "block", "features", "merge", *(["train", "tune", "report"] if a.truth else []), *(["match", "validate"] if a.matches else [])]
    bad = 0
    for stage in wanted:
        if stage == "normalize":
            chain.normalize(spark, sources, a.out, a.clause_aware)
        elif stage == "block":
            chain.block(spark, a.out)
        elif stage == "features":
            chain.featurize(spark, a.out)
        elif stage == "merge":
            chain.merge(spark, a.out, a.truth)
        elif stage == "train":
            say(chain.train(spark, a.out, a.truth, a.iterations))
        elif stage == "tune":
            say({"threshold": chain.tune(spark, a.out, a.truth)})
        elif stage == "report":
            say(chain.report(spark, a.out, a.truth))
        elif stage == "match":
            chain.match(spark, a.out, a.matches, a.candidates, a.by == "model", a.s1 or "")
        else:
            found = chain.check(spark, a.matches, a.candidates, sources, a.check_ids).collect()
            for row in found:
                say(row.asDict())
            bad = int(any(r["severity"] == "error" for r in found))
    return bad


if __name__ == "__main__":
    sys.exit(main())

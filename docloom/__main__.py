"""python -m docloom: blocks, chunks and searches from the command line."""

from __future__ import annotations

import argparse

from docloom.engine import Engine, hashing_encoder
from docloom.session import session
from docloom.sources import files, markup


def render(rows: list, snippet: int = 200) -> str:
    """Hits as text; a snippet of zero or less is the whole text."""
    line = lambda r: f"{r['rank']}. [{r['score']:.3f}] {r['company']} · {r['document_title']} · {' > '.join(r['section_path'] or [])}\n   {r['content'] if snippet <= 0 else r['content'][:snippet]}"
    return "\n".join(map(line, rows))


def repl(ask, read=input, show=print) -> None:
    """Questions line by line; /company NAME, /k N, /full, /reset and /q change what they are asked with."""
    state: dict = {}
    while True:
        try:
            line = read("> ").strip()
        except EOFError:
            return
        word, _, rest = line.partition(" ")
        if word == "/q":
            return
        if word == "/reset":
            state.clear()
        elif word == "/company":
            state["company"] = rest or None
        elif word == "/k":
            state["k"] = int(rest)
        elif word == "/full":
            state["full"] = not state.get("full")
        elif word.startswith("/"):
            show(f"unknown command {word}")
        elif line:
            try:
                show(render(ask(line, state.get("k", 5), company=state.get("company")).collect(), 0 if state.get("full") else 200))
            except LookupError as e:
                show(str(e))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="docloom", description=__doc__)
    sub = p.add_subparsers(dest="what", required=True)
    a = sub.add_parser("blocks", help="raw files to typed blocks")
    a.add_argument("raw")
    a.add_argument("out")
    a.add_argument("--pattern", default="*.xml")
    a = sub.add_parser("chunks", help="blocks to chunks")
    a.add_argument("blocks")
    a.add_argument("out")
    a = sub.add_parser("index", help="chunks to index tables")
    a.add_argument("chunks")
    a.add_argument("out")
    a = sub.add_parser("ask", help="a question to ranked evidence")
    a.add_argument("index")
    a.add_argument("question", nargs="?", help="none: questions are read line by line")
    a.add_argument("-k", type=int, default=5)
    a.add_argument("--company")
    a.add_argument("--no-split", action="store_true")
    a.add_argument("--full", action="store_true")
    o = p.parse_args(argv)
    spark = session()
    if o.what == "blocks":
        files.write_once(markup.parse_blocks(files.decode(files.list_files(spark, o.raw, o.pattern)), "path", "text"), o.out)
    elif o.what == "chunks":
        from docloom.operators.chunks import build_chunks

        files.write_once(build_chunks(spark.read.parquet(o.blocks), "path"), o.out)
    elif o.what == "index":
        Engine.build(spark.read.schema(files.CHUNK).json(o.chunks), path=o.out)
    else:
        from pyspark.sql import functions as F

        from docloom.functions.scalars import coverage_tokens

        index = spark.read.parquet(f"{o.index}/index")
        postings = index.select("row", F.explode(coverage_tokens(F.lower("embedding_text"))).alias("token")).withColumn("weight", F.lit(0.1))
        engine = Engine(spark, index, postings, hashing_encoder())
        if o.question is None:
            repl(engine.ask)
        else:
            print(render(engine.ask(o.question, o.k, not o.no_split, o.company).collect(), 0 if o.full else 200))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

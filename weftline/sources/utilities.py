"""Import dependencies between source files, and file concatenation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pattern of a wildcard import.
IMPORT = r"import\s+([\w:]+)::\*"


def imports(files: DataFrame) -> DataFrame:
    """(path, package): distinct wildcard imports of every file."""
    found = F.array_distinct(F.regexp_extract_all("text", F.lit(IMPORT), F.lit(1)))
    return files.select("path", F.explode(found).alias("package"))


def package_files(packages: DataFrame, files: DataFrame) -> DataFrame:
    """(package, file): the file of a package's own name, or else of its name without ``Package``."""
    names = F.array(F.concat("package", F.lit(".sysml")), F.concat(F.replace("package", F.lit("Package"), F.lit("")), F.lit(".sysml")))
    tries = packages.select("package").distinct().select("package", F.posexplode(names).alias("rank", "base"))
    have = files.select("path", F.element_at(F.split("path", "/"), -1).alias("base"))
    hits = tries.join(have, "base")
    return hits.groupBy("package").agg(F.min_by("path", F.struct("rank", "path")).alias("file"))


def reference_counts(places: DataFrame, root: str) -> DataFrame:
    """(package, references) of a tree's places but for the root, ascending by count and name."""
    return places.where(F.col("vertex") != root).groupBy(F.col("vertex").alias("package")).agg(F.count(F.lit(1)).alias("references")).orderBy("references", "package")


def core_and_utility(edges: DataFrame, standards: list[str]) -> DataFrame:
    """(package, role): core packages depend on another one of the project, utilities on none."""
    ours = edges.select(F.explode(F.array("src", "dst")).alias("package")).distinct().where(~F.col("package").isin(standards))
    deep = edges.where(~F.col("dst").isin(standards)).select(F.col("src").alias("package")).distinct().withColumn("_deep", F.lit(True))
    return ours.join(deep, "package", "left").select("package", F.when(F.col("_deep"), "core").otherwise("utility").alias("role"))


def mermaid(tree: DataFrame) -> str:
    """A flowchart of a dependency tree's edges, with a class per depth (six at most)."""
    rows = tree.select("parent", "vertex", "depth", "way").orderBy("way").collect()  # a diagram's worth
    lines = ["flowchart LR"] + list(dict.fromkeys(f"  {r.parent} --> {r.vertex};" for r in rows if r.parent))
    depth: dict[str, int] = {}
    for r in rows:
        depth.setdefault(r.vertex, r.depth)
    for d in sorted({min(x, 6) for x in depth.values()}):
        lines.append(f"  class {','.join(sorted(v for v, x in depth.items() if min(x, 6) == d))} depth{d}")
    return "\n".join(lines)


def combined(files: DataFrame, header: str = "// ===== {} =====") -> DataFrame:
    """(content): all files in order of their paths, each once and under a header."""
    before, _, after = header.partition("{}")
    once = files.dropDuplicates(["path"])
    part = F.concat(F.lit(before), "path", F.lit(after + "\n"), F.coalesce("text", F.lit("")))
    parts = F.sort_array(F.collect_list(F.struct("path", part.alias("part"))))
    return once.agg(parts.alias("_p")).select(F.array_join(F.transform("_p", lambda p: p["part"]), "\n").alias("content"))

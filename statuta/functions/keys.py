"""Identifiers, paths and orders of laws and articles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from statuta import schema


def article_path(abbrev: Column, number: Column, root: Column | str = "data", phase: Column | None = None) -> Column:
    """root/phase/abbrev/abbrev-article-number.md; null if abbreviation or number is null.

    An absent phase is the default one.  Repeated slashes and ./ steps of the root are taken out; an
    empty root or a single dot adds nothing.
    """
    root = F.lit(root) if isinstance(root, str) else root
    root = F.regexp_replace(F.regexp_replace(root, r"/+(?:\./+)*", "/"), r"(?<=.)/$|^\./", "")
    phase = F.coalesce(phase, F.lit(schema.DEFAULT_PHASE)) if phase is not None else F.lit(schema.DEFAULT_PHASE)
    path = F.concat_ws("/", F.when(~root.isin("", "."), root), phase, abbrev, F.concat(abbrev, F.lit("-article-"), number, F.lit(".md")))
    return F.when(abbrev.isNotNull() & number.isNotNull(), F.when(root == "/", F.substr(path, F.lit(2))).otherwise(path))


def path_keys(path: Column) -> Column:
    """Struct of tier, phase, law_abbrev and article_number from a file's path; the phase directory may be missing."""
    pattern = r"([^/]+)/(?:(phase[0-9]+-[a-z]+)/)?([a-z0-9-]+)/([a-z0-9-]+)-article-([0-9-]+)\.md$"
    part = lambda k: F.nullif(F.regexp_extract(path, pattern, k), F.lit(""))
    return F.struct(part(1).alias("tier"), part(2).alias("phase"), part(3).alias("law_abbrev"), part(5).alias("article_number"))


def article_id(abbrev: Column, number: Column) -> Column:
    return F.concat(abbrev, F.lit("-art-"), number)


def source_url(law_id: Column) -> Column:
    return F.concat(F.lit(schema.SOURCE_BASE), law_id)


def natural_key(number: Column) -> Column:
    """An article number's parts as integers; arrays order as the articles do."""
    return F.transform(F.split(number, "-"), lambda x: x.try_cast("int"))


def branch_depth(number: Column) -> Column:
    return F.size(F.split(number, "-")) - 1


def law_decode(law_id: Column) -> Column:
    """Struct of era, era_year, kind and year from a law's identifier; nulls where it does not follow the pattern."""
    pattern = r"^([1-5])([0-9]{2})(AC|CO|M|CONSTITUTION)[0-9]*$"
    ok = law_id.rlike(pattern)
    era = F.when(ok, F.regexp_extract(law_id, pattern, 1).try_cast("int"))
    in_era = F.when(ok, F.regexp_extract(law_id, pattern, 2).try_cast("int"))
    # The year before each era's first, and the kinds.
    start = F.when(ok, F.get(F.array(*map(F.lit, (1867, 1911, 1925, 1988, 2018))), era - 1))
    name = F.when(ok, F.get(F.array(*map(F.lit, ("Meiji", "Taisho", "Showa", "Heisei", "Reiwa"))), era - 1))
    code = F.regexp_extract(law_id, pattern, 3)
    kind = F.when(code == "AC", "act").when(code == "CO", "cabinet order").when(code == "M", "ministerial ordinance").when(code == "CONSTITUTION", "constitution")
    return F.struct(name.alias("era"), in_era.alias("era_year"), F.when(ok, kind).alias("kind"), (start + in_era).alias("year"))


def default_tags(phase: Column) -> Column:
    return F.array(phase, F.lit("auto-generated"))

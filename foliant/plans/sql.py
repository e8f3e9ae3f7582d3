"""SQL forms of shared expressions, for DuckDB."""

from __future__ import annotations


def subject(c: str) -> str:
    return rf"nullif(regexp_extract(regexp_replace({c}, '[\s\x{{00A0}}\x{{FEFF}}]+', '', 'g'), '^0*([0-9]+)(?:[.,]0*)?$', 1), '')"


def scan(c: str) -> str:
    return rf"nullif(regexp_replace(lower({c}), '^[\s\x{{00A0}}\x{{FEFF}}]+|(?:[\s\x{{00A0}}\x{{FEFF}}]|\.pdf|\.tif)+$', '', 'g'), '')"


def stem(c: str) -> str:
    return rf"regexp_replace({c}, '\.[^.]*$', '')"


def day(c: str) -> str:
    return rf"CASE WHEN regexp_matches(upper(trim({c})), '^\d{{2}}[A-Z]{{3}}\d{{4}}$') THEN try_strptime(upper(trim({c})), '%d%b%Y')::DATE END"

"""Where a linkage project keeps its tables, and the parcel of its results."""

from __future__ import annotations

import os
import zipfile
from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Roots of inputs, work tables and outputs; each may be any path Spark reads. Unset ones lie under ``root``."""

    root: str
    data: str | None = None
    work: str | None = None
    out: str | None = None

    @classmethod
    def from_env(cls, prefix: str = "TESSERA") -> Layout:
        get = lambda k: os.environ.get(f"{prefix}_{k}")
        return cls(get("ROOT") or os.getcwd(), get("DATA"), get("WORK"), get("OUT"))

    def source(self, split: str, src: int) -> str:
        return f"{self.data or f'{self.root}/data'}/{split}_source{src}.tsv"

    def truth(self, split: str = "train") -> str:
        return f"{self.data or f'{self.root}/data'}/{split}_ground_truth.tsv"

    def table(self, *parts: str) -> str:
        return "/".join([self.work or f"{self.root}/work", *parts])

    def output(self, name: str) -> str:
        return f"{self.out or f'{self.root}/output'}/{name}"


def parcel(files: dict[str, str], path: str) -> None:
    """A zip of local files under given names; a file that is missing is an error before anything is written."""
    if missing := [p for p in files.values() if not os.path.isfile(p)]:
        raise FileNotFoundError(", ".join(missing))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, p in files.items():
            z.write(p, name)

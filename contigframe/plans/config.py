"""Options of an annotation run, the layout of a reference bundle, and checks made before any work starts."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields, replace

#: Profiles: the tiers they switch on.
FAST = ("tmrna", "crispr", "oric", "gaps", "tandem", "sorf", "pseudo")
FULL = (*FAST, "signal_peptide", "localization", "gene_score", "full_mode")
#: option: places below a bundle's root, the first that exists counts. Fixed values.
BUNDLE = {
    "ncbifams": ("hmm/ncbifams.hmm",), "antifam": ("hmm/antifam.hmm",), "amr": ("hmm/amr.hmm",), "pfam": ("hmm/pfam.hmm",), "ncrna": ("ncrna",), "kofam": ("kofam",), "psc": ("psc",), "vfdb": ("vfdb",), "amr_variants": ("amr_variants",),
    "plasmid": ("plasmid",), "species": ("species",), "phage": ("phage/phage_hallmark.hmm",), "integron": ("integron",), "orit": ("orit/oriT_exp.fasta", "orit/oriT_all.fasta"), "isdb": ("isdb",), "xref": ("xref",), "rfam_type": ("xref/rfam_type.tsv",),
}
SIDECARS = ("{d}/{n}", "{d}/meta/{n}", "{d}/../{n}", "{d}/../meta/{n}")


@dataclass(frozen=True)
class Config:
    genome: str = ""
    paths: dict[str, str] = field(default_factory=dict)
    genetic_code: int | None = None
    tmrna: bool = False
    crispr: bool = False
    oric: bool = False
    gaps: bool = False
    tandem: bool = False
    sorf: bool = False
    pseudo: bool = False
    start_refine: bool = False
    signal_peptide: bool = False
    localization: bool = False
    gene_score: bool = False
    full_mode: bool = False
    locus_prefix: str = "CF"

    def profile(self, name: str) -> Config:
        """With a profile's tiers on: fast, full, or all, which is full."""
        tiers = {"fast": FAST, "full": FULL, "all": FULL}[name]
        return replace(self, **{t: True for t in tiers})

    def with_bundle(self, root: str) -> Config:
        """Paths that the bundle has; those given explicitly win, and what is absent stays off."""
        found = {}
        for option, places in BUNDLE.items():
            at = next((p for p in (os.path.join(root, x) for x in places) if os.path.exists(p)), None)
            if at:
                found[option] = at
        return replace(self, paths={**found, **self.paths})


def find_sidecar(folder: str, name: str) -> str | None:
    return next((p for p in (s.format(d=folder, n=name) for s in SIDECARS) if os.path.isfile(p)), None)


def validate(config: Config) -> None:
    """The genome and each configured path exist and aren't empty; the first that doesn't is named."""
    for option, path in [("genome", config.genome), *sorted(config.paths.items())]:
        if not path or not os.path.exists(path):
            raise FileNotFoundError(f"{option}: {path or 'not given'}")
        if os.path.isfile(path) and os.path.getsize(path) == 0:
            raise ValueError(f"{option}: {path} is empty")


def short_reason(error: Exception) -> str:
    """A tag for a tier that was skipped."""
    text = str(error).lower()
    for tag, words in (("missing database", ("no such file", "not found", "missing")), ("search program unavailable", ("program", "executable")), ("bad input", ("parse", "invalid"))):
        if any(w in text for w in words):
            return tag
    return "error"


def option_names() -> list[str]:
    return [f.name for f in fields(Config)]

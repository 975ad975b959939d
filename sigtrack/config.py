"""What a run works on: samples, relationships, windows, thresholds."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import NamedTuple

BACKENDS = ("uncalled4", "remora")
PER_READ = (*BACKENDS, "mod-calls")
_ENDINGS = (".gz", ".fastq", ".fq", ".bam", ".fa", ".fasta", ".bed")


class Relationship(NamedTuple):
    sample: str
    treatment: str
    control: str
    treatment_path: str
    control_path: str
    aligned: bool


class Feature(NamedTuple):
    name: str
    n_windows: int = 1000
    window: int = 10


def stripped(name: str) -> str:
    """A name without the known endings, each at most once and in order."""
    for e in _ENDINGS:
        name = name.removesuffix(e)
    return name


def sample_name(path: str) -> str:
    return stripped(path.rstrip("/").rsplit("/", 1)[-1])


@dataclass
class JobConfig:
    genomes: list[str] = field(default_factory=list)
    features: list[Feature] = field(default_factory=list)
    density_windows: list[int] = field(default_factory=list)
    mean_windows: list[int] = field(default_factory=list)
    levels: list[int] = field(default_factory=list)
    relationships: list[Relationship] = field(default_factory=list)
    temporary: list[str] = field(default_factory=list)
    mapq: int = 0
    backends: list[str] = field(default_factory=list)
    per_read: list[str] = field(default_factory=list)
    pools: dict[str, list[str]] = field(default_factory=dict)
    signal: dict[str, str] = field(default_factory=dict)
    options: dict[str, str] = field(default_factory=dict)
    #: settings of single steps and their defaults
    signal_window_size: int = 10_000
    mod_fpr: float | None = 0.02
    mod_pval: float | None = None
    mod_fisher_lag: int = 1
    mod_mad: float = 15.0
    mod_max_obs_per_kmer: int = 20_000
    mod_min_kmer_obs: int = 30
    reactivity_cov_threshold: int = 10
    correlation_subsamples: int = 10_000

    @classmethod
    def parse(cls, text: str) -> JobConfig:
        """From lines ``^key<tab>value...``; others and comments mean nothing."""
        c = cls()
        for line in text.splitlines():
            m = re.match(r"\^(\S+)\s*(.*)", line)
            if not m:
                continue
            key, v = m[1], [x.strip() for x in m[2].split("\t")]
            match key:
                case "g":
                    c.genomes.append(stripped(v[0]))
                case "f":
                    c.features.append(Feature(stripped(v[0]), *(int(x) for x in v[1:3] if x)))
                case "w":
                    c.density_windows.append(int(v[0]))
                case "a":
                    c.mean_windows.append(int(v[0]))
                case "s":
                    c.levels.append(int(v[0]))
                case "r" | "u":
                    c.relationships.append(Relationship(v[0], sample_name(v[1]), sample_name(v[2]), v[1].rstrip("/"), v[2].rstrip("/"), key == "u"))
                case "t":
                    c.temporary.append(v[0].rstrip("/"))
                case "filter-mapq":
                    if not v[0].isdecimal():
                        raise ValueError(f"filter-mapq takes a whole number of 0 or more, not {v[0]!r}")
                    c.mapq = int(v[0])
                case "mod-calls":
                    c.backends.append(v[0])
                case "per-read":
                    c.per_read.append(v[0])
                case "mod-pool":
                    name, *members = m[2].split()
                    c.pools[name] = members
                case "pod5":
                    c.signal[v[0]] = v[1].rstrip("/")
                case _:
                    c.options[key] = v[0]
        c.check()
        return c

    def check(self) -> None:
        """Known words, levels from 0 to 4, pools of two or more, one path for each sample name."""
        for word, known in [*((b, BACKENDS) for b in self.backends), *((p, PER_READ) for p in self.per_read)]:
            if word not in known:
                raise ValueError(f"{word!r} is none of {', '.join(known)}")
        if bad := [s for s in self.levels if not 0 <= s <= 4]:
            raise ValueError(f"significance levels are 0 to 4, not {bad}")
        if small := [n for n, m in self.pools.items() if len(set(m)) < 2]:
            raise ValueError(f"pools of less than two samples: {', '.join(small)}")
        paths: dict[str, tuple[str, bool]] = {}
        for r in self.relationships:
            for name, path in ((r.treatment, r.treatment_path), (r.control, r.control_path)):
                if paths.setdefault(name, (path, r.aligned)) != (path, r.aligned):
                    raise ValueError(f"{name} stands for two inputs: {paths[name][0]} and {path}")

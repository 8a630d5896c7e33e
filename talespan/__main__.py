"""``python -m talespan``: process the new transcripts of the configured folder.

Settings come from the environment or a ``.env`` file: MODEL, DATA_FOLDER, OUTPUT_FOLDER,
OPENAI_API_KEY, TOKEN_LIMIT, MINUTES_PER_BATCH, FORCE_RELOAD, and for the thesaurus THESAURUS
(path or http address), EXCLUDE_FLAG, EXCLUDED_SCHEME, CAMP_SCHEME, LOCATION_SCHEME, LABEL_LANGUAGE,
and EMBEDDING_MODEL ("hashing" works offline).
"""

from __future__ import annotations

import os
import time

from pyspark.sql import SparkSession

from talespan.backends.chat import backend_for
from talespan.backends.embed import HashingEmbedder, TransformerEmbedder
from talespan.config import ConfigError, EngineConfig
from talespan.functions.tokens import CharacterCounter, RankCounter
from talespan.operators.thesaurus import Vocabulary
from talespan.plans.pipeline import run
from talespan.runtime import ship
from talespan.sources.ntriples import download


def read_env(path: str = ".env") -> dict[str, str]:
    """The environment over the settings of a file of ``NAME=value`` lines."""
    found: dict[str, str] = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                name, sign, value = line.strip().partition("=")
                if sign and not name.startswith("#"):
                    found[name.strip()] = value.strip().strip("'\"")
    return found | dict(os.environ)


def elapsed_text(seconds: float) -> str:
    return f"{seconds:.2f} seconds" if seconds < 60 else f"{int(seconds // 60)} min {seconds % 60:.0f} sec"


def main() -> None:
    began, env = time.time(), read_env()
    config = EngineConfig.from_env(env)
    source = env.get("THESAURUS", "")
    if not source:
        raise ConfigError("THESAURUS is not set")
    if not os.path.isdir(config.data_folder.removeprefix("file://")) and "://" not in config.data_folder:
        raise FileNotFoundError(f"folder does not exist: {config.data_folder}")
    backend = backend_for(config.model, config.api_key)
    embedder = HashingEmbedder() if env.get("EMBEDDING_MODEL", "hashing") == "hashing" else TransformerEmbedder(env["EMBEDDING_MODEL"])
    counter = RankCounter() if os.path.exists("/opt/tokenizers/byte_bpe_50k.tiktoken") else CharacterCounter()
    if source.startswith("http"):
        source = download(source, f"{config.output_folder}/cache/thesaurus.nt")
    vocabulary = Vocabulary(flag=env.get("EXCLUDE_FLAG", ""), excluded_scheme=env.get("EXCLUDED_SCHEME", ""), camp_scheme=env.get("CAMP_SCHEME", ""),
                            location_scheme=env.get("LOCATION_SCHEME", ""), language=env.get("LABEL_LANGUAGE", "nl"))
    spark = SparkSession.builder.appName("talespan").getOrCreate()
    ship(spark)
    n = run(spark, config, source, vocabulary, backend, embedder, counter)
    print(f"{n} transcripts in {elapsed_text(time.time() - began)}")


if __name__ == "__main__":
    main()

"""All registered queries of this subpackage."""

from tessera.llm import decontaminate as _op2  # noqa: F401
from tessera.llm import embedding_dedup as _op13  # noqa: F401
from tessera.llm import kneser_ney as _op10  # noqa: F401
from tessera.llm import phrase_dedup as _op6  # noqa: F401
from tessera.llm import piece_codec as _op8  # noqa: F401
from tessera.llm import simhash_dedup as _op7  # noqa: F401
from tessera.llm import prefix_trie as _op11  # noqa: F401
from tessera.llm import quality_rules as _op9  # noqa: F401
from tessera.llm import toxicity as _op1  # noqa: F401
from tessera.llm import warc as _op3  # noqa: F401
from tessera.llm import vector_codes as _op12  # noqa: F401
from tessera.llm import url_filter as _op5  # noqa: F401
from tessera.llm import suffix_dedup as _op4  # noqa: F401
from tessera.llm.common import REGISTRY

QUERIES = REGISTRY.queries
ORACLE = REGISTRY.oracle

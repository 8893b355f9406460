"""The queries of this subpackage, one a operator, and the pipeline; SQL where it can express one."""

from __future__ import annotations

import corpus_pipeline

from .bpe import op10_bpe
from .conversations import op13_conversation_repair
from .decontaminate import op4_decontamination
from .license_scan import op3_license_scan
from .media import op9_media
from .ngram_join import op8_ngram_join
from .pii import op1_personal_data
from .secret_scan import op7_secrets
from .sharding import op11_sharding
from .spelling import op12_spelling_variants
from .token_ids import op2_token_ids
from .toxicity import op6_toxicity
from .url_filter import OP5_SQL, op5_url_filter


def queries():
    own = (op1_personal_data, op2_token_ids, op3_license_scan, op4_decontamination, op5_url_filter, op6_toxicity, op7_secrets, op8_ngram_join, op9_media, op10_bpe, op11_sharding, op12_spelling_variants, op13_conversation_repair)
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    return {"op5_url_filter": OP5_SQL}

"""Every operator of this subpackage as a query over its whole table, and its SQL where SQL can express it."""

from gridlake.llm import chat, collocations, ngram_join, quality_rules, url_filters
from gridlake.llm.chat import op5_chat_formatting
from gridlake.llm.collocations import op13_collocations
from gridlake.llm.conversation_repair import op11_conversation_repair
from gridlake.llm.decontamination import op7_decontamination
from gridlake.llm.ngram_join import op2_ngram_join
from gridlake.llm.packing import op10_packing
from gridlake.llm.pii import op6_pii
from gridlake.llm.quality_classifier import op9_quality_classifier
from gridlake.llm.quality_rules import op8_quality_rules
from gridlake.llm.secret_scan import op12_secret_scan
from gridlake.llm.token_counts import op1_token_counts
from gridlake.llm.toxicity import op3_toxicity
from gridlake.llm.url_filters import op4_url_filters

QUERIES = {f.__name__: f for f in (op1_token_counts, op2_ngram_join, op3_toxicity, op4_url_filters, op5_chat_formatting,
                              op6_pii, op7_decontamination, op8_quality_rules, op9_quality_classifier, op10_packing,
                              op11_conversation_repair, op12_secret_scan, op13_collocations)}
ORACLE = {"op2_ngram_join": ngram_join.ORACLE_SQL, "op4_url_filters": url_filters.ORACLE_SQL, "op5_chat_formatting": chat.ORACLE_SQL,
          "op8_quality_rules": quality_rules.ORACLE_SQL, "op13_collocations": collocations.ORACLE_SQL}

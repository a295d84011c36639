"""Inference rules from dependency-parsed text, as Spark DataFrame operators."""

from pathkin.functions.parse import (
    detect_head_base,
    is_auxiliary,
    is_filler,
    is_noun,
    is_path_verb,
    is_preposition,
    ngram_segments,
    ngram_tokens,
    resolve_parents,
)
from pathkin.functions.paths import format_rule, path_of, slot_of, split_path
from pathkin.functions.scores import f1, lin, mi, ordered_pair, pair_key, partial
from pathkin.functions.text import score_or_zero, stem, to_real, to_whole, trim_control
from pathkin.operators.counting import (
    count_triples,
    marginals,
    path_slot_counts,
    path_totals,
    slot_word_counts,
    total_count,
)
from pathkin.operators.evaluation import (
    best_threshold,
    curve_f1,
    error_cutoffs,
    error_samples,
    gold_without,
    pr_auc,
    pr_curve,
    sample_curve,
    score_gold,
    score_ladder,
    similarity_stats,
    threshold_metrics,
)
from pathkin.operators.extraction import extract_arcs, extract_occurrences, extraction_report
from pathkin.operators.information import mutual_information, mutual_information_from
from pathkin.operators.similarity import (
    feature_pairs,
    lin_normalize,
    path_similarity,
    score_pairs,
    sum_partials,
)
from pathkin.plans.rules import count_corpus, discover_rules, evaluate_rules
from pathkin.sources.readers import (
    label_pairs,
    parse_marginals,
    parse_mi,
    parse_partials,
    parse_path_totals,
    parse_system_scores,
    parse_triples,
    read_gold,
    read_marginals,
    read_mi,
    read_ngram_lines,
    read_partials,
    read_path_totals,
    read_system_scores,
    read_triples,
)
from pathkin.sources.stages import clean_stage, fingerprint, restartable, stage_manifest
from pathkin.sources.writers import marginal_lines, write_marginals, write_stage, write_tsv

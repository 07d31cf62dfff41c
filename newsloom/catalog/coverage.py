"""
SQL cannot state, or that need files of a given name, have tests instead (named test_...)."""

OPERATORS = {
    "S1": ["json_arrays", "run_table", "one_run", "test_json_array_in_order"],
    "S2": ["run_table"],
    "S3": ["test_json_runs_carry_the_run_of_their_name", "dedupe_history"],
    "S4": ["one_run", "test_a_run_is_not_a_prefix"],
    "S5": ["four_way_join", "one_run"],
    "S6": ["response_files", "saved_bodies"],
    "S7": ["text_lines"],
    "S8": ["one_run", "test_missing_tables"],
    "S9": ["test_json_array_in_order", "json_arrays"],
    "S10": ["keyword_fanout"],
    "S11": ["crawled_articles"],
    "K1": ["run_table"],
    "K2": ["request_files", "rewritten_requests", "answers_in_two_polls"],
    "K3": ["upserted_run"],
    "K4": ["run_table"],
    "K5": ["run_ledger"],
    "K6": ["selection_file"],
    "K7": ["post_files"],
    "K8": ["post_log"],
    "K9": ["deleted_content"],
    "K10": ["saved_bodies", "polled_bodies"],
    "P1": ["validate_records", "searched_articles"],
    "P2": ["validity_answers", "response_files"],
    "P3": ["validity_answers", "relevance_answers"],
    "P4": ["composite_keys", "validity_answers"],
    "P5": ["composite_keys", "request_lines"],
    "P6": ["searched_articles", "select_rename"],
    "P7": ["searched_articles", "union_sources"],
    "P8": ["relevant_articles"],
    "P9": ["relevant_articles"],
    "P10": ["normalized_names"],
    "P11": ["page_origin"],
    "P12": ["register_sources"],
    "P13": ["describe_articles"],
    "P14": ["unify_sources"],
    "P15": ["row_json_round_trip"],
    "P16": ["score_columns_per_persona"],
    "P17": ["score_recode"],
    "P18": ["select_rename"],
    "P19": ["surrogate_ids", "crawled_articles"],
    "P20": ["request_lines", "request_files", "test_request_lines"],
    "P21": ["truncate_escape", "request_lines"],
    "F1": ["score_columns_per_persona", "relevant_articles"],
    "F2": ["scalar_relevance", "test_both_forms_of_relevance", "relevant_by_either_form"],
    "F3": ["relevant_pairs"],
    "F4": ["drop_empty", "consolidate_hits"],
    "F5": ["drop_empty", "read_content"],
    "F6": ["matching_links", "register_sources"],
    "F7": ["select_rename"],
    "F8": ["scalar_relevance", "matching_links"],
    "F9": ["null_guards"],
    "F10": ["repeated_source_names", "profiles_with_repeats"],
    "F11": ["valid_content"],
    "F12": ["one_run", "dedupe_history"],
    "F13": ["contract_faults", "contract_check", "relevance_answers"],
    "J1": ["dedupe_history"],
    "J2": ["dedupe_title"],
    "J3": ["relevant_articles", "unmatched_outputs"],
    "J4": ["four_way_join", "joined_counts"],
    "J5": ["valid_content", "deleted_content"],
    "J6": ["nearest_to_queries", "nearest_of_all", "nearest_by_cells", "nearest_among_faulty"],
    "J7": ["embedding_calls"],
    "J8": ["relevant_pairs", "post_messages", "post_prompts"],
    "J9": ["keyword_fanout", "keyword_phrases"],
    "A1": ["consolidate_hits", "consolidate_hits_in_parts", "article_searches"],
    "A2": ["value_counts"],
    "A3": ["count_present"],
    "A4": ["source_profile"],
    "A5": ["distinct_sources"],
    "A6": ["row_counts", "test_two_runs"],
    "A7": ["centroid"],
    "A8": ["batch_status", "waiting_batches"],
    "A9": ["last_wins", "upserted_run"],
    "A10": ["duplicate_report", "later_copies", "repeated_source_names"],
    "A11": ["distinct_values"],
    "A12": ["latest_run"],
    "W1": ["assign_batches", "assign_batches_per_run"],
    "W2": ["token_chunks", "token_chunks_strict"],
    "W3": ["sampled_examples", "test_seeded_sample"],
    "W4": ["numbered_examples"],
    "W5": ["pick_row", "pick_per_source"],
    "T1": ["latest_article"],
    "T2": ["files_by_number"],
    "T3": ["nearest_to_queries", "nearest_by_cells", "test_cells_that_are_too_far_are_not_read"],
    "T4": ["nearest_to_centroid"],
    "T5": ["source_profile"],
    "T6": ["preview"],
    "U1": ["union_sources"],
    "U2": ["run_table", "response_files"],
    "U3": ["dedupe_history"],
    "X1": ["truncate_escape", "test_dedent"],
    "X2": ["publish_days"],
    "X3": ["array_math"],
    "X4": ["extract_links"],
    "X5": ["relevance_answers", "score_columns_per_persona"],
    "X6": ["row_json_round_trip"],
    "X7": ["array_math", "latest_run"],
    "X8": ["null_guards"],
    "X9": ["token_counts"],
    "X10": ["call_to_action", "test_call_to_action_is_in_about_half"],
    "V1": ["distance_to_label"],
    "V2": ["assign_topics", "test_topics", "topic_properties"],
    "V3": ["project", "test_projection", "projection_properties"],
    "M1": ["request_lines", "request_files"],
    "M2": ["apply_predictor", "stored_answers", "answers_in_two_polls", "test_changed_requests_go_out_again"],
    "M3": ["contract_faults", "validity_answers", "relevance_answers"],
    "M4": ["extract_links", "crawled_articles"],
    "M5": ["page_text", "read_content", "read_content_of_copies"],
    "M6": ["keyword_relevance", "score_articles", "keyword_phrases"],
    "M7": ["validity_rules", "keep_valid"],
    "M8": ["scored_summaries", "lead_summary", "summarize"],
    "M9": ["embed_texts", "term_counts", "embedding_calls"],
    "M10": ["post_prompts", "post_messages"],
    "M11": ["generated_posts"],
    "R1": ["incremental_dedupe", "test_runs_as_they_land"],
    "D1": ["searched_articles"],
    "D2": ["consolidate_hits"],
    "D3": ["request_files"],
    "D4": ["apply_predictor", "embedding_calls"],
    "Q1": ["register_sources", "repeated_source_names"],
    "Q2": ["crawled_articles"],
    "Q3": ["searched_articles"],
    "Q4": ["dedupe_history", "union_sources", "test_two_runs", "combined_run"],
    "Q5": ["score_articles", "test_a_run_waits_for_files"],
    "Q6": ["read_content", "keep_valid", "resumed_run"],
    "Q7": ["summarize", "embedding_calls", "resumed_run"],
    "Q8": ["four_way_join", "select_rename", "latest_article", "test_two_runs", "analysed_articles"],
    "Q9": ["assign_topics", "project", "search_texts", "nearest_to_centroid"],
    "Q10": ["post_prompts", "generated_posts", "post_files"],
    "Q11": ["source_profile", "profiles_with_repeats", "distinct_sources", "test_past_posts"],
    "Q12": ["batch_status", "latest_run", "run_ledger", "saved_bodies", "waiting_batches", "resumed_run"],
}

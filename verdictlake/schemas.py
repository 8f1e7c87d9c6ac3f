"""Contract schemas as DDL. Free-form mappings are JSON text, never inferred."""

TURN = "struct<role:string,content:string,audio_url:string>"
TOOL_EVENT = ("struct<name:string,input:string,output:string,is_error:boolean,"
              "turn_idx:int,seq:int,external:boolean>")

SCHEMAS = {
    "sessions": "session_id string, name string, created_at timestamp, last_activity timestamp",
    "ci_policy": "session_id string, pass_rate_floor double, max_concurrency int, default_pass_rate double",
    "run_configs": "run_id string, dataset_id string, max_turns int, concurrency int, repeats int, "
                   "timeout_minutes double, pass_rate double, min_scenarios int, baseline_branch string, "
                   "max_regression double, raw_config string",
    "user_models": "user_model_id string, probe_session_id string, persona string, traits array<string>, "
                   "representation_id string, session_id string, created_at timestamp",
    "scenarios": "scenario_id string, representation_id string, task_family string, controls string, "
                 "spec string, title string, origin string",
    "datasets": "dataset_id string, generation_id string, user_model_id string, row_count int, "
                "session_id string, label string, created_at timestamp",
    "dataset_rows": "dataset_id string, scenario_id string, random_seed bigint",
    "rollouts": "rollout_id string, check_id string, scenario_id string, dataset_id string, status string, turn int, "
                "max_turns int, random_seed bigint, end_reason string, agent_meta string, voiced boolean, "
                "created_at timestamp, completed_at timestamp",
    "transcripts": f"rollout_id string, first_turn int, transcript array<{TURN}>, tool_events array<{TOOL_EVENT}>",
    "turns": "rollout_id string, turn_idx int, role string, content string, audio_url string",
    "tool_events": "rollout_id string, seq int, turn_idx int, name string, input string, output string, "
                   "is_error boolean, external boolean",
    "sandboxes": "rollout_id string, turn_idx int, seed bigint, fail_tools array<string>, state string",
    "quality_checks": "check_id string, session_id string, label string, branch string, status string, "
                      "created_at timestamp, error string, effective_config string",
    "evaluations": "check_id string, rollout_id string, eval_seq int, passed boolean, states array<string>, "
                   "judge string",
    "validations": "validation_id string, dataset_id string, scenario_id string, passed boolean, judge string",
    "run_events": "run_id string, seq bigint, event_id string, stage string, message string, data string, "
                  "created_at timestamp",
    "requests": "event_id bigint, route string, method string, status int, api_key_id string, latency_ms double, "
                "created_at timestamp",
    "issues": "issue_id string, created_at timestamp, source string, failure_summary string, "
              "failure_category string, tools_involved array<string>, generation_id string, status string",
    "seeds": "seed_id string, kind string, source string, version string, content string, filename string, "
             "metadata string",
    "voice_renders": "render_id string, rollout_id string, status string, duration_ms int, wpm double",
    "tier_results": "simulation_id string, tier string, violations array<string>, tool_calls int, "
                    "goals_met int, goals_total int",
}

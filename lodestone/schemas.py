"""Table schemas of the engine."""

SYMBOL = "struct<name:string,kind:string,path:string,line:int,qualified_name:string>"
FILES = (
    f"path string, language string, mtime_ns bigint, size bigint, sha256 string, imports array<string>, symbols array<{SYMBOL}>, "
    "`references` array<string>, routes array<string>, database_models array<string>, configuration boolean, owners array<string>, "
    "is_test boolean, parse_error string"
)
RUN_EVENTS = "session_id string, turn_id string, id string, ts timestamp, kind string, status string, detail string, metadata string"
MODEL_CALLS = (
    "session_id string, turn_id string, id string, ts timestamp, role string, model string, status string, "
    "usage struct<prompt_tokens:bigint,completion_tokens:bigint>, task_id string, detail string"
)
TOOL_CALLS = (
    "session_id string, turn_id string, id string, ts timestamp, tool string, status string, arguments string, task_id string, "
    "evidence_id string, duration_ms bigint"
)
EVIDENCE = (
    "id string, ts timestamp, session_id string, kind string, claim string, status string, tool string, command string, exit_code int, "
    "artifacts array<struct<path:string,`exists`:boolean,sha256:string,size:bigint>>, raw_output string, metadata string"
)
PLAN_STEPS = (
    "plan_id string, id int, title string, description string, depends_on array<int>, permitted_files array<string>, risk string, "
    "retry_limit int, attempts int, max_tool_calls int, status string, result string, error string"
)
BENCHMARK_RESULTS = (
    "suite string, version string, task_id string, category string, status string, duration_ms bigint, agent_status string, "
    "changed_files array<string>, unexpected_files array<string>, model_calls int, prompt_tokens bigint, completion_tokens bigint, "
    "estimated_cost_usd double, retries int"
)
SESSIONS = "session_id string, working_dir string, updated_at string, turns array<struct<turn_id:string,status:string,request:string>>"

"""Fixed schemas of the engine's tables."""

MASTER = (
    "emp_id string, name string, org string, dept string, title string, grade string, join_date date, exit_date date, "
    "snapshot_year int, data_source string, sheet_name string"
)
MASTER_COLUMNS = [c.split()[0] for c in MASTER.split(", ")]
ROSTER = "year int, type string, name string, source_file string, sheet string"
CELLS = "file string, sheet string, sheet_idx int, row_idx int, col_idx int, value string"
ALIAS = "raw_org string, raw_dept string, std_org string, std_dept string, note string"
MANIFEST = "path string, size long, mtime timestamp, sha1 string"
SKILL = "name string, emp_id string, skill_text string, experience string, source_file string, sheet string"
RECRUIT = "name string, skill_text string, level string, result string, source_file string, sheet string"
MASTER_ONLY = ["snapshot_year", "emp_id", "name", "org", "dept", "data_source", "sheet_name"]

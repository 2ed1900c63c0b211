"""Domain constants: header synonyms, signals and keyword lists of personnel workbooks.

Fixed values: they must be these for right results.
"""

#: Canonical field to header synonyms, the preferred first.
ALIASES = {
    "emp_id": ["emp_id", "사번", "사원번호", "사원 번호", "사원ID", "사원코드", "직원코드", "No", "번호"],
    "name": ["name", "이름", "성명", "사원명", "직원명", "구성원명", "퇴사자명", "입사자명"],
    "org": ["org", "본부", "사업본부", "조직", "소속", "부문", "센터", "실", "그룹"],
    "dept": ["dept", "부서", "팀", "파트", "스쿼드", "unit", "소속팀", "팀명", "부서명"],
    "title": ["title", "직무", "직책", "직무명", "직책명"],
    "grade": ["grade", "등급", "직급", "직위", "평가등급"],
    "join_date": ["join_date", "입사일", "입사일자", "입사년월일", "입사"],
    "exit_date": ["exit_date", "퇴사일", "퇴사일자", "퇴사년월일", "퇴사", "퇴직일", "퇴직일자"],
    "snapshot_year": ["snapshot_year", "년도", "연도", "기준연도", "스냅샷연도"],
}

#: Columns that never enter a table: by part of their name at ingest, by whole name before every sink.
SENSITIVE_PARTS = ["주민등록번호", "주민번호", "rrn", "휴대폰", "핸드폰", "내선번호", "e-mail", "email", "이메일", "집주소", "address", "birth", "생일"]
SENSITIVE_NAMES = ["주민등록번호", "resident_id", "집주소", "address", "핸드폰", "phone", "e-mail", "email", "내선번호", "birth", "생일"]

#: Sheet classifier signals.
ID_SIGNALS = ["사번", "사원코드", "사원번호", "emp_id", "employeeid"]
JOIN_SIGNALS = ["입사일", "입사일자", "joindate", "hiredate"]
EXIT_SIGNALS = ["퇴사일", "퇴사일자", "exitdate", "terminationdate"]
NAME_SIGNALS = ["이름", "성명", "사원명", "구성원명", "name"]
SKILL_SIGNALS = ["기술스택", "개발스텍", "개발스택", "스킬", "skill", "stack", "역량"]
PRICE_SIGNALS = ["단가", "투입공수", "매출", "연봉", "급여", "인상", "simu"]
CONTACT_SIGNALS = ["휴대폰", "핸드폰", "내선번호", "e-mail", "이메일", "email"]
RESIDENT_SIGNALS = ["주민등록번호", "주민번호", "rrn"]
RECRUIT_SIGNALS = ["채용", "지원자", "경력기술서", "skillinventory"]
GRADE_SIGNALS = ["등급", "grade", "hr검토", "최종확정"]
ORG_SIGNALS = ["조직도", "orgchart"]
SKIP_SHEETS = ["가이드", "guide", "설명", "기준", "작성기준", "실적관리가이드", "sheet2", "색인", "index", "본부별년차별인원수"]
MASTER_SHEETS = ["재직자", "퇴사자", "입사자", "프로그래머", "엔지니어"]

#: Kinds of sheets, the most telling of a file's first; and where a file of a kind belongs.
KINDS = ["master", "reference_roster", "aux_skill", "aux_recruit", "aux_pricing", "sensitive_drop", "aux_personalcard", "org_chart", "unknown"]
FOLDERS = {
    "master": "headcount", "reference_roster": "roster", "aux_skill": "skills", "aux_recruit": "recruit", "aux_personalcard": "evaluation",
    "aux_pricing": "pricing", "sensitive_drop": "sensitive", "org_chart": "org_chart", "unknown": "unknown",
}
#: Kind of a whole file by the folder that it was sorted into.
FOLDER_KINDS = {
    "headcount": "master_candidate", "roster": "aux_reference_roster", "skills": "aux_skill", "recruit": "aux_recruit", "evaluation": "aux_personalcard",
    "pricing": "aux_pricing", "sensitive": "sensitive_drop", "org_chart": "org_chart", "unknown": "unmatched_excel",
}
#: Kind of a whole file by the kind of its sheets.
FILE_KINDS = {"master": "master_candidate", "reference_roster": "aux_reference_roster", "skip": "unmatched_excel", "unknown": "master_candidate"}
#: Keywords of file names, tried in this order.
FILE_NAMES = [
    ("org_chart", ["조직도", "orgchart"]),
    ("aux_pricing", ["단가", "연봉", "simu", "실적관리", "견적", "제안서"]),
    ("aux_recruit", ["채용", "recruit", "지원자", "skill inventory"]),
    ("aux_skill", ["기술스택", "스킬", "skill", "개발스텍"]),
    ("aux_personalcard", ["인사기록카드", "개인이력카드", "경력기술서"]),
    ("sensitive_drop", ["연락망", "주소록"]),
]

#: Old binary workbooks are sorted by these keywords of their names, tried in this order.
XLS_NAMES = [
    ("master", ["인원현황", "재직자", "퇴사자", "입사자", "인력등급"]),
    ("reference_roster", ["명단", "roster"]),
    ("org_chart", ["조직도", "orgchart"]),
    ("aux_skill", ["스킬", "skill", "기술스택"]),
    ("aux_recruit", ["채용", "recruit"]),
    ("aux_pricing", ["단가", "연봉", "투입", "실적", "simu", "급여", "인상"]),
    ("aux_personalcard", ["인사기록카드", "개인이력카드", "평가"]),
]

#: Header needles of headcount, of skill and recruiting, and of turnover sheets; words of sheet names.
HEADCOUNT_NEEDLES = ["사번", "사원코드", "사원번호", "이름", "성명", "사원명", "name", "employee"]
AUX_NEEDLES = ["성명", "이름", "사원명", "name", "employee", "skill", "스킬", "기술"]
ROSTER_NEEDLES = ["입사자", "퇴사자", "퇴직자"]
ACTIVE_SHEETS, EXITED_SHEETS, SURVEY_SHEETS = ["재직", "현원", "인원", "조직"], ["퇴사", "퇴직"], ["설문", "survey"]

#: Keys of skill and recruiting sheets.
SKILL_KEYS = {
    "name": ["성명", "이름", "사원명", "name"], "emp_id": ["사번", "사원번호", "사원코드", "emp_id", "employeeid", "id"],
    "skill_text": ["기술", "기술스택", "스킬", "skill", "stack"], "experience": ["경험여부", "경험", "experience"],
}
RECRUIT_KEYS = {
    "name": ["성명", "이름", "지원자", "name"], "skill_text": ["skill", "스킬", "기술", "기술스택", "stack"],
    "level": ["레벨", "등급", "숙련", "level"], "result": ["결과", "합격", "불합격", "result", "status"],
}

#: Career sheets by position; 5 to 7 are sensitive.
CAREER_COLUMNS = {
    0: "seq", 1: "role_type", 2: "name", 3: "grade", 4: "org", 8: "join_date", 9: "education", 17: "career_grade",
    21: "prev_career_months", 23: "tenure_months", 25: "total_career_months",
}

#: Thresholds.
HEADER_ROWS, UNNAMED_SHARE = 26, 0.7
HEADCOUNT_ROWS, AUX_ROWS = 200, 50
SCAN_ROWS, SCAN_SHARE = 8, 0.6
EARLY_DAYS, SERIAL_LOW, SERIAL_HIGH, FOUNDED = 30, 20000, 60000, "2002-01-22"
RISK_HIGH, RISK_MID, EXIT_RATE_BAD, EXIT_RATE_WARN, EARLY_WARN = 70, 40, 15, 10, 5
FINGERPRINT_BYTES = 1 << 20
UNKNOWN_LABEL = "(미상)"
NULL_TOKENS = ["", "nan", "None"]

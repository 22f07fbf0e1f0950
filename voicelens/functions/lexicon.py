"""Word lists and codes.

FIXED VALUES — these must equal the values of the original review pipeline
for equal results.  They are listed plainly, in their original order.
Every operator takes them as a parameter, so other lists can be passed in.
"""

# FIXED VALUES: aspect codes, airline side then airport side.
AIRLINE_CODES = ["B1", "B2", "B3", "B4", "B5", "B6", "B7", "B8", "B9", "JGP"]
AIRPORT_CODES = ["J1", "J2", "J3", "J4", "J6"]
ALL_CODES = AIRLINE_CODES + AIRPORT_CODES
# FIXED VALUES: code of irregular-flight service (left out on normal flights).
IRREGULAR_CODE = "B9"
# FIXED VALUES: codes matched in airport context.
AIRPORT_CONTEXT_CODES = ["J2", "J3"]
# FIXED VALUES: codes counted on the airline side of the target object (B9 left out).
ADO_AIRLINE_CODES = ["B1", "B2", "B3", "B4", "B5", "B6", "B7", "B8", "JGP"]
ADO_AIRPORT_CODES = ["J1", "J2", "J3", "J4", "J6"]

# FIXED VALUES: contrast connectors that open a new clause, as typed.
CONNECTORS = [
    "但是", "就是", "然而", "反而", "而", "偏偏", "只是", "不过", "至于",
    "可是", "致", "不料", "不过", "岂知", "但", "然后", "再者", "另外", "此外", "再有",
    "由于", "好在", "另方面", "另方面", "倒是", "反倒是", "值得一提的是", "最重要的是", "最主重要的是",
]

# FIXED VALUES: airport facility words that route a clause to the airport codes, as typed.
FACILITY_WORDS = [
    "自助机", "转盘", "指示牌", "饮水机",
    "休息室", "吸烟室", "推车", "免税店", "基础设施",
    "机场设施", "机场建设", "机场环境", "机场广播", "机场服务", "候机座位", "候机区",
    "行李推车", "贵宾休息室", "贵宾厅", "贵宾室", "地勤", "地勤服务", "地面服务", "地服", "安检通道",
    "安检", "柜台值机", "候机座位", "候机楼", "候机室", "转盘",
]
# FIXED VALUES: substring that also routes a clause to the airport codes.
AIRPORT_SUBSTRING = "机场"

# FIXED VALUES: opinion words that behave like verbs of judgement.
SPECIAL_OPINIONS = [
    "可以", "满意", "还可以", "不错", "非常周到", "非常满意", "不满意", "很满意",
    "人性化", "周到", "比较好", "挤", "还不错", "很舒服", "比较差", "很棒", "较差", "比较满意",
]

# FIXED VALUES: negation words (the candidate-refinement list, 60 entries as typed).
NEGATIONS = [
    "不必", "木有", "怎么不", "从来不", "请勿", "不曾", "不会", "未尝", "禁止", "勿", "拒绝", "放弃", "缺少", "放下",
    "甭", "极少", "不大", "毫无", "毋", "绝非", "不要", "没有", "不能", "没怎么", "尚无", "不怎么", "不该", "莫", "从未有过",
    "反对", "非", "无", "没", "永不", "尚未", "不甚", "很少", "从未", "停止", "不", "绝不", "一无", "并非", "切莫", "并未", "杜绝",
    "未", "几乎不", "终止", "缺乏", "不丁点儿", "不用", "不是", "未曾", "难以", "从没", "不可以", "从不", "毫不", "不",
]

# FIXED VALUES: POS and relation classes used by the opinion rules.
CHILD_POS_ASPECT = ["a", "ws", "b", "v"]
CHILD_POS_PREDICATE = ["a", "ws", "b", "i"]
CHILD_POS_ADJECTIVAL = ["a", "ws", "b"]
NEIGHBOUR_POS = ["n", "d", "m", "a"]

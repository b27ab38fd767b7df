"""Fixed values of the domain, and the language profile that text operators take as a parameter.

Everything that is a rule rather than a computation lives here as plain data, so that a caller can
replace a table without touching an operator.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- fixed values: categories, slots, labels -------------------------------------------------------
CATEGORIES = ("国内", "海外", "経済", "社会", "科学", "テクノロジー", "エンタメ", "スポーツ", "その他")
OTHER_CATEGORY = "その他"
ARTICLE_TYPES = ("brief", "feature")
SLOT_HOURS = {"06": 6, "12": 12, "18": 18}
SLOT_LABELS = {"06": "朝6時版", "12": "昼12時版", "18": "夕方6時版"}

# fixed values: limits
MAX_CANDIDATES = 24
MAX_PER_PUBLISHER_IN = 6
MAX_PUBLISHERS_PER_CATEGORY = 4
MAX_ARTICLES = 18
MAX_PER_PUBLISHER_OUT = 3
MIN_PUBLISHERS = 3
MAX_FEATURES = 3
SECTION_CAPS = {"facts": 10, "impact": 8, "background": 3, "watch": 6}
SECTION_WIDTHS = {"facts": 240, "impact": 240, "background": 240, "watch": 180}
BACKGROUND_CHARS = 520
FEATURE_MIN_POINTS = 3
FEATURE_MIN_CHARS = 180
FEATURE_RICH_SOURCE_CHARS = 80
FEATURE_SUMMARY_CHARS = 80
FEATURE_MAX_AGE_HOURS = 48
SEEN_SIMILARITY = 0.86
CLUSTER_SIMILARITY = 0.78
FEATURE_SIMILARITY = 0.72
SEEN_HOURS = 36
STATE_LIMIT = 8000
STATE_DAYS = 180
STATE_VERSION = 1
ARCHIVE_LIMIT = 540
GRACE_MINUTES = 90
CONTEXT_HOURS = 24
CONTEXT_LIMIT = 24
CATCHUP_LIMIT = 9
MAX_MISSING_WINDOWS = 61

# fixed values: URL tracking parameters dropped in addition to utm_*
TRACKING_PARAMETERS = ("fbclid", "gclid", "igshid", "mc_cid", "mc_eid", "ref", "ref_src")

# fixed values: bracket pairs that must nest
BRACKETS = {"「": "」", "『": "』", "（": "）", "(": ")", "【": "】", "［": "］", "[": "]"}

# fixed values: seismic intensity ranks
INTENSITY_RANKS = {
    "0": 0.0, "1": 1.0, "2": 2.0, "3": 3.0, "4": 4.0,
    "5-": 5.0, "5弱": 5.0, "5+": 5.5, "5強": 5.5,
    "6-": 6.0, "6弱": 6.0, "6+": 6.5, "6強": 6.5, "7": 7.0,
}
INTENSITY_DISPLAY = {"5-": "5弱", "5+": "5強", "6-": "6弱", "6+": "6強"}

# fixed values: families of categories whose reporting may describe one event
CATEGORY_FAMILIES = {
    "public": ("国内", "社会", "経済", "海外", "国際", "その他"),
    "technology_culture": ("テクノロジー", "科学", "文化", "エンタメ"),
}

# fixed values: stems that show a sentence was cut in the middle
TRUNCATED_STEMS = ("があ", "てい", "であ", "となっ", "につい", "およ", "ならび", "踏まえ", "受けてい")

# fixed values: patterns of instruction-like spans in untrusted text
INJECTION_PATTERNS = (
    r"(?i:\b(?:ignore|disregard|forget|override)\b.{0,60}\b(?:previous|prior|above|system|developer)\b.{0,40}"
    r"\b(?:instruction|prompt|message|rule)s?\b)",
    r"(?:以前|これまで|上記|下記|システム|開発者).{0,30}(?:指示|命令|プロンプト|メッセージ).{0,30}"
    r"(?:無視|忘れ|破棄|上書き|従え|従って)",
    r"(?i:(?:system|developer|assistant)\s*(?:prompt|message)?\s*:)",
    r"(?i:(?:you are|act as)\s+(?:chatgpt|an?\s+assistant|the system))",
    r"(?:あなたは|今から).{0,20}(?:ChatGPT|AI|アシスタント|システム)",
)
ROLE_TAGS = r"(?i)</?(?:system|developer|assistant|user|prompt|instruction)[^>]*>"

# fixed values: category inference from supplied tags, then from text (first match wins)
TAG_CATEGORIES = {
    "社会": "社会", "スポーツ": "スポーツ", "ビジネス": "経済", "経済": "経済", "政治": "国内",
    "国際": "海外", "海外": "海外", "サイエンス": "科学", "科学": "科学", "文化芸能": "エンタメ",
    "エンタメ": "エンタメ", "テクノロジー": "テクノロジー", "デジタル化": "テクノロジー",
    "サイバーセキュリティ": "テクノロジー", "it・デジタル": "テクノロジー",
    "it・デジタルのトラブル": "テクノロジー", "労働": "経済", "経営": "経済", "税": "経済", "観光": "経済",
    "エネルギー": "経済", "経済・労働・税": "経済", "防犯": "社会", "交通安全": "社会",
    "防災・災害対策": "社会", "安心・安全（その他）": "社会", "教育・学び": "社会", "健康": "科学",
    "医療": "科学", "病気予防": "科学", "環境・エコ": "科学",
}
TEXT_CATEGORY_RULES = (
    ("スポーツ",
     r"野球|甲子園|大リーグ|プロ野球|投手|球団|サッカー|Jリーグ|ワールドカップ|五輪|オリンピック|パラリンピック|陸上|"
     r"テニス|ゴルフ|相撲|競泳|バスケット|バレー|ラグビー|(?:^|[^a-z])F1(?:[^a-z]|$)"),
    ("エンタメ",
     r"映画|ドラマ|俳優|女優|芸能|音楽|マンガ|漫画|アニメ|ゲーム|ホラー|怪談|妖怪|舞台|小説|文学|美術|展覧会|アイドル|歌手"),
    ("海外",
     r"ウクライナ|ロシア|インドネシア|北朝鮮|韓国(?!籍)|中国(?!地方|籍)|台湾|香港|米国|アメリカ|英国(?!籍)|イギリス|"
     r"フランス|ドイツ|欧州|(?:^|[^a-z])EU(?:[^a-z]|$)|国連|ガザ|イスラエル|パレスチナ|イラン|シリア|アフリカ|"
     r"アフガニスタン|アフガン|タリバン|リヒテンシュタイン|エジプト|フィリピン|ブラジル|インド|海外"),
    ("テクノロジー",
     r"(?:^|[^a-z])AI(?:[^a-z]|$)|人工知能|生成AI|Claude|ChatGPT|サイバー|ソフトウェア|アプリ|スマホ|iPhone|クラウド|"
     r"半導体|ロボット|デジタル|(?:^|[^a-z])IT(?:[^a-z]|$)"),
    ("経済",
     r"物価|価格|高騰|値上げ|値下げ|株価|株式|為替|円相場|金利|景気|経済|企業|決算|市場|賃金|給与|雇用|失業|輸出|輸入|関税|"
     r"金融|銀行|投資|買収|売却|倒産|(?:^|[^a-z])GDP(?:[^a-z]|$)|プロテイン"),
    ("科学", r"宇宙|科学|研究|医療|感染症|ワクチン|新型コロナ|治療|患者|気候変動|生物|化石|天文|探査機|衛星"),
    ("社会",
     r"事故|火災|逮捕|事件|容疑|裁判|判決|軽傷|重傷|けが|死亡|災害|地震|大雨|警報|避難|教育|学校|給食|自治体"),
)

# fixed values: desk correction of a category by title (first match wins; the third ignores case)
TITLE_CATEGORY_RULES = (
    ("スポーツ", r"高校野球|甲子園|プロ野球|野球|投手|打者|本塁打|ホームラン|サッカー|ゴール|リーグ|選手|監督|チーム|"
                r"準決勝|決勝|優勝|敗戦|勝利"),
    ("エンタメ", r"映画|音楽|芸能|俳優|女優|歌手|アニメ|ドラマ|漫画|舞台|テレビ番組"),
    ("テクノロジー", r"(?i:生成AI|人工知能|\bAI\b|Claude|ChatGPT|半導体|ソフトウェア|アプリ|スマートフォン|サイバー|ゲーム|"
                    r"デジタル|ロボット)"),
    ("海外", r"ウクライナ|ロシア|インドネシア|アメリカ|米国|中国|韓国|北朝鮮|フランス|ドイツ|イギリス|英国|EU|欧州|国連|中東|"
            r"イスラエル|パレスチナ|台湾|インド|ブラジル|コロンビア|海外|首脳会議"),
)

# fixed values: sentence classes, alert words, bulletin fields
WATCH = r"今後|見込み|見通し|おそれ|可能性|予定|次回|続報|更新予定|公表予定|発表予定|留意|注視|引き続き確認"
CONCRETE_IMPACT = (
    r"対象(?:地域|区域|者|世帯)|影響|被害|避難|警報|注意報|警戒情報|危険警報|浸水|増水|氾濫|土砂災害|暴風|強風|大雨|落雷|"
    r"突風|津波|海面変動|降灰|最大波|到達予想時刻|交通|欠航|運休|停電|震度[0-7０-７](?:弱|強)?\s*[:：]|レベル[1-5１-５]"
)
BROAD_IMPACT = r"警戒|注意(?:が必要|してください|を呼びかけ)|危険|避難|被害|影響"
BACKGROUND = r"これまで|背景(?:には|として|は)?|過去(?:に|の)|従来|前回|当初|以前から|以来"
ALERT_WORDS = r"速報|地震|津波|台風|選挙|首相|緊急|死者|最高裁"
BULLETIN_FIELDS = (
    r"発生時刻\s*[:：]",
    r"震央・震源地域\s*[:：]",
    r"マグニチュード\s*[:：]",
    r"最大震度\s*[:：]",
    r"(?:津波|海面変動).*(?:心配|警報|注意報|予報|対象地域)",
)
BULLETIN_PUBLISHER = "jma"

# fixed values: event themes whose headlines paraphrase each other: all patterns must match the folded text
EVENT_THEMES = (
    ("yasukuni:end-of-war-day", (r"靖国", r"参拝|玉串|終戦の日")),
    ("technology:claude-watermark", (r"claude", r"透かし|watermark")),
)
# fixed values: quakes identified by region, date and magnitude
QUAKE_WORDS = r"地震|震源|マグニチュード"
QUAKE_REGIONS = (("earthquake:indonesia-flores", r"インドネシア|フローレス"),)


def forbidden_copy(site_name: str) -> str:
    """Boilerplate that must not appear in feature copy (fixed values, plus the site's own summary credit)."""
    credit = "".join("\\" + ch if ch in r".^$*+?{}[]\|()" else ch for ch in site_name)
    return rf"と配信|を軸に|主要\d+項目|面の焦点|横断整理|配信元の|{credit}が要約|公開情報を確認"


@dataclass(frozen=True)
class Profile:
    """Language-dependent parameters of the text operators."""

    script: str = r"\u3040-\u30ff\u3400-\u9fff"  # characters that make text readable to the audience
    letters: str = r"A-Za-z\u3040-\u30ff\u3400-\u9fff"
    script_share: float = 0.12
    terminators: str = "。！？!?"
    full_stop: str = "。"
    truncated_stems: tuple[str, ...] = TRUNCATED_STEMS
    injections: tuple[str, ...] = INJECTION_PATTERNS
    watch: str = WATCH
    concrete_impact: str = CONCRETE_IMPACT
    broad_impact: str = BROAD_IMPACT
    background: str = BACKGROUND
    alert_words: str = ALERT_WORDS
    bulletin_fields: tuple[str, ...] = BULLETIN_FIELDS
    bulletin_publisher: str = BULLETIN_PUBLISHER
    title_categories: tuple[tuple[str, str], ...] = TITLE_CATEGORY_RULES
    text_categories: tuple[tuple[str, str], ...] = TEXT_CATEGORY_RULES
    tag_categories: dict[str, str] = field(default_factory=lambda: TAG_CATEGORIES)
    themes: tuple[tuple[str, tuple[str, ...]], ...] = EVENT_THEMES
    quake_words: str = QUAKE_WORDS
    quake_regions: tuple[tuple[str, str], ...] = QUAKE_REGIONS
    site_name: str = "the desk"


JAPANESE = Profile()

# Rule tables for Latin-script text, used on the fixture tables.
LATIN = Profile(
    script=r"A-Za-z",
    letters=r"A-Za-z\u3040-\u30ff\u3400-\u9fff",
    terminators=".。！？!?",
    full_stop=".",
    truncated_stems=(" th", " qu", " ge"),
    watch=r"(?i:\b(?:will|by|sur|zu|por)\b)",
    concrete_impact=r"(?i:\b(?:with|avec|mit|con)\b)",
    broad_impact=r"(?i:\b(?:this|dans|und|para)\b)",
    background=r"(?i:\b(?:was|from|du|das|del)\b)",
    alert_words=r"(?i:\b(?:are|pas|ein|las)\b)",
    title_categories=(
        ("スポーツ", r"(?i:\b(?:with|mit)\b)"),
        ("エンタメ", r"(?i:\b(?:are|avec)\b)"),
        ("テクノロジー", r"(?i:\b(?:this|las)\b)"),
        ("海外", r"(?i:\b(?:dans|und)\b)"),
    ),
    text_categories=(
        ("スポーツ", r"\b(?:threed|ounon)\w*"),
        ("エンタメ", r"\b(?:avec|mit)\b"),
        ("海外", r"\b(?:dans|und)\b"),
        ("テクノロジー", r"\bthis\b"),
        ("経済", r"\bwas\b"),
        ("科学", r"\bfrom\b"),
        ("社会", r"\b(?:are|para)\b"),
    ),
)

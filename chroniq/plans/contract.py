"""Fixed values of the contract that a campaign's documents keep."""

# fixed values, in their declared order
REQUIRED_FILES = (
    "README.md", "MANIFEST.md", "CURRENT.md", "CHANGELOG.md", ".gitignore", "chatgpt-project/SETUP_AND_PROMPTS.md", "campaign/premises.md",
    "campaign/established-facts.md", "campaign/timeline.md", "campaign/open-threads.md", "campaign/clocks.md", "party/party.md", "party/character-template.md",
    "npcs/index.md", "npcs/npc-template.md", "locations/index.md", "locations/location-template.md", "rules/precedence.md", "rules/house-rules.md",
    "rules/rulings.md", "rules/quick-reference.md", "gm/secrets.md", "gm/factions.md", "gm/future-events.md", "gm/module-overrides.md", "journal/README.md",
    "journal/entry-template.md", "checkpoints/README.md", "checkpoints/checkpoint-template.yaml", "archive/README.md", "templates/README.md",
    "templates/reset-paths.txt", "templates/CURRENT.md", "scripts/reset_campaign.sh", "scripts/validate_repo.py",
)
RESET_LIST = "templates/reset-paths.txt"
RESET_PATHS = ("CURRENT.md", "archive", "campaign", "checkpoints", "gm", "journal", "locations", "npcs", "party", "rules")
ENTITY_TEMPLATES = ("party/character-template.md", "npcs/npc-template.md", "locations/location-template.md")
ENTITY_KEYS = ("id", "type", "name", "status", "location", "knowledge_level", "last_updated")
ENTITY_FILES = r"party/character-[^/]*\.md|npcs/[^/]*\.md|locations/[^/]*\.md"
CHECKPOINT_FILES, JOURNAL_FILES = r"\Acheckpoints/cp-[^/]*\.yaml\z", r"\Ajournal/entry-[^/]*\.md\z"
CURRENT_KEYS = ("checkpoint_id", "active_scene_id", "active_journal_id", "campaign_status", "last_activity_at")
SECTIONS = {
    "CURRENT.md": (
        "Метаданные кампании", "Непрерывность", "Внутриигровая дата и время", "Текущее местоположение", "Присутствующие персонажи", "Непосредственная ситуация",
        "Активные угрозы", "Активные часы", "Важные ресурсы группы", "Текущие состояния персонажей", "Ожидающие решения", "Недавно установленные факты",
        "Файлы последнего checkpoint", "Следующая рекомендуемая точка загрузки",
    ),
    "party/character-template.md": (
        "Концепция", "Игровые показатели", "Здоровье и состояния", "Способности", "Инвентарь", "Расходуемые ресурсы", "Отношения", "Цели",
        "Знания и важные разговоры", "Известные секреты", "Заметки по развитию", "История изменений",
    ),
    "npcs/npc-template.md": (
        "Краткое описание", "Внешний вид", "Роль", "Мотивация", "Текущая цель", "Ресурсы", "Игровые показатели", "Отношение к персонажам", "Что NPC знает",
        "Что о нём знают игроки", "Секреты", "Текущее состояние", "История изменений",
    ),
    "locations/location-template.md": (
        "Краткое описание", "Текущее состояние", "Выходы и связи", "Находящиеся здесь сущности", "Опасности", "Ресурсы", "Доступные действия",
        "Что известно игрокам", "Секреты ведущего", "Изменения относительно исходного приключения", "История изменений",
    ),
}
ID = r"[a-z0-9]+(?:[.-][a-z0-9]+)+"
CHECKPOINT, SCENE, JOURNAL, EVENT = r"cp-\d{4}", r"scene-\d{4}", r"journal\.entry-\d{4}", r"event-\d{3,}"
REFERENCE = r"(?<![a-zA-Z0-9])([a-z][a-z0-9]*(?:[.-][a-z0-9]+)+)"
LINK = r"(?<!!)\[[^\]]+\]\(([^)]+)\)"
ID_LINE = r"(?iU)\A\s*id\s*:\s*(.*?)\s*\z"
LEGACY = r"(?iu)sessions/|session-(?U)\d{3,4}|сесси"
LEGACY_EXEMPT = "CHANGELOG.md"
GUIDE, GUIDE_TERMS = "chatgpt-project/SETUP_AND_PROMPTS.md", ("PDF правил", "PDF приключения", "attachment")
SCHEMA = "campaign-checkpoint/v1"
SCENE_KEYS = ("fiction_time", "location", "present", "situation", "active_threats", "key_resources", "pending_decisions")
EVENT_TYPES = ("action", "dialogue", "discovery")
CHANGE_OPERATIONS, CHANGE_FIELDS = ("set", "add", "remove", "move"), ("operation", "target", "reason", "source_event")
RESOURCE_OPERATIONS = ("add", "update", "transfer", "consume", "remove")
RESOURCE_FIELDS = (
    "id", "operation", "name", "quantity_before", "quantity_after", "holder_before", "holder_after", "condition_before", "condition_after", "capabilities",
    "limitations", "maintenance", "load_limit", "noise", "light", "consumption", "source_event",
)
FACT_KINDS, TRUTH = ("established", "npc-claim", "rumor", "belief"), ("confirmed", "unverified", "false", "mixed")
FACT_FIELDS = ("id", "kind", "content", "truth_status", "knowledge_level", "source_event")
THREAD_OPERATIONS, THREAD_FIELDS, THREAD_ADD = ("add", "update", "close"), ("operation", "thread_id", "source_event"), ("title", "question", "status", "knowledge_level")
KNOWLEDGE_OPERATIONS, KNOWLEDGE_FIELDS = ("add", "update", "remove"), ("operation", "subject", "knowledge_ref", "summary", "source_event")
NULLS = ("", "null", "~")
# end of fixed values

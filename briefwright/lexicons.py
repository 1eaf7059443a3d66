"""Word lists of the scoring, routing and clustering rules.

Every list is a default: the operators take a ``Lexicon`` argument, so a user may replace any group
with a table of (group, term) rows.
"""

from __future__ import annotations

# The results depend on these exact terms.
TERMS: dict[str, list[str]] = {
    "stopwords": [
        "the", "and", "for", "with", "from", "that", "this", "into", "about", "after", "before",
        "over", "under", "will", "have", "has", "are", "was", "were", "been", "using", "uses", "use",
        "your", "their", "they", "you", "our", "its", "new", "now", "more", "less", "than", "then",
        "what", "when", "where", "which", "why", "how", "https", "http", "com", "www", "amp", "via",
        "can", "one", "all", "not", "but",
    ],
    "known_actors": [
        "openai", "chatgpt", "gpt", "anthropic", "claude", "google", "gemini", "deepmind", "microsoft",
        "github", "copilot", "meta", "llama", "nvidia", "amd", "intel", "apple", "mistral", "qwen",
        "deepseek", "xai", "spacex", "colossus", "huggingface", "cloudflare", "cursor", "windsurf",
        "codex", "mcp", "cuda",
    ],
    "technical": [
        "model", "models", "reasoning", "training", "inference", "benchmark", "paper", "papers",
        "research", "architecture", "multimodal", "diffusion", "robot", "robotics", "vla", "retrieval",
        "rag", "red", "team", "safety", "alignment", "scaling",
    ],
    "product": [
        "launch", "release", "introducing", "update", "updates", "api", "app", "apps", "product",
        "feature", "features", "agent", "agents", "coding", "code", "developer", "workflow", "deploy",
        "deployment", "excel", "sheets", "limits", "rate", "usage",
    ],
    "business": [
        "deal", "partnership", "revenue", "earnings", "forecast", "stock", "funding", "investment",
        "acquire", "acquisition", "lawsuit", "copyright", "regulation", "market", "compute",
        "capacity", "datacenter", "data", "center", "energy", "nuclear", "chip", "chips",
    ],
    "novelty": [
        "first", "new", "introducing", "launch", "release", "breakthrough", "novel", "v2", "v3", "v4",
        "v5", "preview", "beta", "open", "source", "record", "largest", "fastest",
    ],
    "reader_relevance": [
        "agent", "agents", "coding", "code", "developer", "mcp", "workflow", "automation", "product",
        "startup", "business", "compute", "infra", "infrastructure", "model", "models", "reasoning",
        "api", "tool", "tools", "deploy", "deployment", "quant", "finance",
    ],
    "major_release": [
        "new model", "major model", "major release", "major update", "big version", "大版本", "版本升级",
        "模型升级", "1m context", "million context", "1m token", "1m tokens", "1m 上下文", "百万上下文", "超长上下文",
        "multimodal", "多模态", "native multimodal", "原生多模态", "msa", "segment-wise attention", "price",
        "pricing", "api pricing", "价格", "定价", "api", "开放平台",
    ],
    "official_accounts": [
        "claudeai", "anthropicai", "openai", "googledeepmind", "googleai", "google", "metaai",
        "aiatmeta", "deepseek_ai", "deepseekcoder", "moonshotai", "kimi_ai", "bigmodel_cn", "zai_org",
        "minimax__ai", "minimaxir", "xai", "grok", "cursor_ai", "thinkingmachines",
    ],
    "survey": [
        "survey", "review", "overview", "taxonomy", "tutorial", "综述", "surveying",
    ],
    "position": [
        "position", "opinion", "perspective", "essay", "whitepaper",
    ],
    "benchmark": [
        "benchmark", "benchmarks", "leaderboard", "eval", "evaluation", "dataset", "datasets", "suite",
    ],
    "empirical": [
        "experiment", "experiments", "ablation", "ablate", "benchmark", "benchmarks", "evaluation",
        "eval", "results", "sota", "state-of-the-art", "dataset", "datasets", "leaderboard",
        "human study", "user study", "real-world", "production", "deployment",
    ],
    "breakthrough": [
        "breakthrough", "state-of-the-art", "sota", "first", "novel", "new paradigm", "paradigm",
        "record", "largest", "fastest", "outperform", "outperforms", "scaling law", "emergent",
        "agentic", "reasoning", "long-context", "multi-agent",
    ],
    "reproducibility": [
        "code", "github", "open source", "open-source", "dataset", "datasets", "reproduce",
        "reproducible", "replication", "artifact", "demo", "weights", "model card", "paperswithcode",
    ],
    "credibility": [
        "neurips", "iclr", "icml", "acl", "emnlp", "cvpr", "iccv", "eccv", "siggraph", "kdd", "osdi",
        "sosp", "mlsys", "nature", "science", "best paper", "oral", "spotlight", "accepted",
        "peer-reviewed", "openreview",
    ],
    "industrial_practice": [
        "production", "prod", "deployed", "deployment", "deploying", "serving", "served", "real-world",
        "real world", "industrial", "industry", "large-scale", "large scale", "at-scale", "at scale",
        "online", "live", "users", "traffic", "a/b test", "ab test", "experiment at", "launched",
        "used by", "powers", "ranking system", "recommendation system", "serving stack",
        "inference stack", "largest user model",
    ],
    "correction": [
        "replication", "reproduce", "reproduced", "reproduces", "reproducibility",
        "failed to reproduce", "cannot reproduce", "negative result", "counterexample", "debunk",
        "debunked", "reversal", "correction", "erratum", "follow-up", "follow up", "limitation",
        "limitations", "boundary", "scope", "only works", "does not generalize", "fails on",
        "underperforms", "regression", "smaller than", "less than", "under 10b", "<10b", "<=10b",
        "below 10b", "small model", "small models", "caveat", "caveats", "stress test", "stress-test",
        "red team",
    ],
    "community_practice": [
        "community benchmark", "community benchmarks", "benchmark", "benchmarks", "benchmarked",
        "real hardware", "local inference", "llama.cpp", "mlx", "vllm", "sglang", "exllama", "tok/s",
        "tokens/s", "t/s", "throughput", "latency", "perplexity", "ppl", "vram", "rtx", "5090", "4090",
        "3090", "m1", "m2", "m3", "m4", "jetson", "doesn't scale", "does not scale", "won't scale",
        "cannot scale", "can't scale", "not scale", "no longer works", "not production",
        "production default", "not default", "failed in practice", "fails in practice",
        "practical limit", "real-world limit", "hype faded", "after the hype", "current status",
        "pull request", "implementation",
    ],
    "media_actor": [
        "openai", "anthropic", "claude", "google", "deepmind", "gemini", "microsoft", "github",
        "copilot", "meta", "llama", "nvidia", "mistral", "deepseek", "xai", "cursor", "windsurf",
        "cognition", "devin", "langchain", "langsmith", "huggingface",
    ],
    "media_role": [
        "cto", "chief", "founder", "co-founder", "cofounder", "ceo", "vp", "head of", "technical lead",
        "tech lead", "research lead", "lead researcher", "principal scientist", "scientist",
        "researcher", "engineer", "architect", "creator", "maintainer",
    ],
    "media_knowledge": [
        "production", "deploy", "deployment", "serving", "scale", "scaling", "roadmap", "architecture",
        "inference", "training", "token", "tokens", "cost", "pricing", "benchmark", "eval",
        "evaluation", "agent", "agents", "coding", "code", "workflow", "pull request", "pull requests",
        "prs", "7x", "80%", "mcp", "context", "memory", "postmortem", "lessons", "strategy",
        "enterprise", "roi", "jobs", "tokenmaxxing",
    ],
    "generic_learning": [
        "academy", "course", "tutorial", "intro", "introduction", "getting started", "beginner", "101",
        "webinar", "workshop", "class", "lesson", "playlist", "paper club",
    ],
    "hard_evidence": [
        "funding", "financing", "raises", "raised", "capital raise", "equity capital", "investment",
        "valuation", "revenue", "earnings", "guidance", "forecast", "results", "profit", "capex",
        "capital expenditure", "backlog", "orders", "demand", "server demand", "ai server", "servers",
        "data center", "datacenter", "compute capacity", "available", "availability",
        "cloud availability", "enterprise", "aws", "amazon web services", "bedrock", "govcloud", "sec",
        "s-1", "ipo", "open source", "open-source", "open model", "weights", "training scripts",
    ],
    "hard_evidence_infra": [
        "ai", "artificial intelligence", "compute", "infrastructure", "infra", "gpu", "gpus", "h100",
        "h200", "b200", "blackwell", "server", "servers", "ai server", "data center", "datacenter",
        "training", "inference", "model", "models", "frontier model", "frontier models", "codex",
        "cloud", "capacity", "accelerator", "semiconductor", "chip", "physical ai", "world model",
        "robotics",
    ],
    "event_cloud": [
        "aws", "amazon web services", "bedrock", "govcloud", "cloud", "cloud availability",
        "enterprise", "enterprise distribution", "available", "availability", "frontier model",
        "frontier models", "codex", "api", "security", "governance",
    ],
    "event_capital": [
        "capital raise", "equity capital", "funding", "financing", "raises", "raised", "investment",
        "valuation", "capex", "capital expenditure", "earnings", "revenue", "guidance", "backlog",
        "server demand", "ai server", "ipo", "s-1", "sec",
    ],
    "event_infra": [
        "data center", "datacenter", "compute capacity", "infrastructure", "infra", "gw", "gigawatt",
        "mw", "megawatt", "power", "capacity", "oracle", "blackstone", "server", "servers",
        "networking", "gpu", "gpus", "blackwell",
    ],
    "event_open_model": [
        "open source", "open-source", "open model", "open weights", "weights", "model weights",
        "training scripts", "deployment tools", "dataset", "datasets", "model card", "github",
    ],
    "event_capability": [
        "role-specific", "role specific", "role based", "role-based", "plugin", "plugins",
        "custom plugin", "custom plugins", "sites", "site", "annotations", "annotation", "citation",
        "citations", "sources", "connectors", "connector", "workspace", "background task",
        "background tasks", "code review", "review comments", "pull request", "pull requests",
        "developer workflow", "developer workflows", "tools", "tool use", "agent", "agents", "codex",
        "chatgpt", "assistant", "assistants", "api",
    ],
    "event_ship": [
        "launch", "launches", "launched", "release", "released", "introducing", "announce",
        "announces", "announced", "available", "availability", "rollout", "rolls out", "ships",
        "shipping", "adds", "added", "now supports", "supports", "new", "update", "updates", "upgrade",
        "improvements", "beta", "preview",
    ],
    "event_filing": [
        "sec", "s-1", "draft s-1", "ipo", "confidentially submits", "filing",
    ],
    "commentary": [
        "commentary", "reaction", "rapid reaction", "conversation", "interview", "podcast", "did",
        "fall behind", "falls behind", "behind again", "debate", "discusses", "discussion", "analysis",
        "explained", "what happens", "what's next",
    ],
    "architecture_release": [
        "breaking architecture", "architecture change", "architecture changes",
        "architecture overhaul", "architectural overhaul", "redesign", "protocol redesign",
        "runtime rewrite", "scheduler rewrite", "engine rewrite", "serving rewrite", "storage rewrite",
        "full rewrite", "new runtime", "new architecture", "inference serving architecture",
        "migration guide", "breaking change", "breaking changes", "backward incompatible",
        "infra-critical", "infrastructure-critical",
    ],
    "finance_relevant": [
        "ai", "artificial intelligence", "machine learning", "llm", "generative ai", "openai",
        "anthropic", "deepmind", "gemini", "claude", "chatgpt", "nvidia", "gpu", "h100", "h200",
        "b200", "blackwell", "cuda", "semiconductor", "chip", "chips", "accelerator", "tsmc", "asml",
        "broadcom", "data center", "datacenter", "cloud", "hyperscaler", "inference", "training",
        "ai server", "co-packaged optics", "hbm", "memory chip", "microsoft", "google", "alphabet",
        "meta", "amazon", "aws", "apple", "tesla",
    ],
    "relevance_tags": [
        "ai", "llm", "ml", "model", "models", "agent", "agents", "infra", "research", "paper",
        "benchmark", "eval", "coding", "developer-tools", "developer_tools", "multimodal", "robotics",
        "rag", "inference",
    ],
    "relevance_terms": [
        "ai", "artificial intelligence", "agi", "llm", "large language model", "machine learning",
        "generative ai", "foundation model", "reasoning model", "multimodal", "vision-language",
        "openai", "chatgpt", "gpt", "anthropic", "claude", "deepmind", "gemini", "gemma", "llama",
        "mistral", "mixtral", "qwen", "kimi", "moonshot", "deepseek", "hugging face", "huggingface",
        "transformer", "diffusion", "embedding", "reranker", "benchmark", "eval", "fine-tuning",
        "finetune", "rlhf", "distillation", "alignment", "safety", "red team", "agent", "agents",
        "agentic", "mcp", "rag", "retrieval", "tool use", "function calling", "cursor", "copilot",
        "codex", "claude code", "ai coding", "vibe coding", "devin", "langchain", "llamaindex", "vllm",
        "sglang", "ollama", "inference", "serving", "gpu", "nvidia", "cuda", "h100", "h200", "b200",
        "blackwell", "hbm", "datacenter", "data center", "ai server", "semiconductor", "chip",
        "accelerator", "tpu", "npu", "云", "算力", "芯片", "显卡", "推理", "训练", "大模型", "模型", "智能体", "多模态",
        "人工智能", "开源模型", "评测", "基准", "具身", "机器人", "自动驾驶", "代码生成",
    ],
    "route_strong": [
        "elf: embedded language flows", "embedded language flows", "cola-dlm", "cola dlm",
        "continuous latent diffusion language model",
        "continuous latent-space diffusion language model", "latent diffusion language model",
        "diffusion language model", "diffusion language models", "recursive self-improvement",
        "self-improving llm", "self-improving language model",
        "continual learning for language models", "continual learning for llms",
    ],
    "route_phrase": [
        "continuous embedding", "continuous embeddings", "continuous latent",
        "continuous latent-space", "continuous latent space", "latent representation",
        "latent representations", "representation space", "representation-space", "discrete token",
        "discrete tokens", "token autoregression", "flow matching", "non-autoregressive",
        "non autoregressive", "not predict next token", "not predicting next token",
        "not next-token prediction", "not next token prediction", "continual learning",
        "continuous learning", "continue learning", "lifelong learning", "online learning",
        "test-time learning", "test time learning", "test-time adaptation", "test time adaptation",
        "self-improvement", "self improvement", "self-improving", "self improving", "beyond scaling",
        "beyond scale", "scaling alternative", "alternatives to scaling", "non-scaling", "non scaling",
        "非主流 scale", "非 scale",
    ],
    "route_context": [
        "ai", "artificial intelligence", "model", "models", "foundation model", "foundation models",
        "language model", "language models", "language generation", "large language model",
        "large language models", "llm", "llms", "text generation", "agent", "agents", "tokens",
        "token", "大模型", "模型", "智能体",
    ],
    "finance_generic": [
        "s&p", "s&p 500", "nasdaq", "dow", "index", "indices", "market", "markets", "macro",
        "inflation", "fed", "rate cut", "treasury", "yield", "earnings", "stocks", "shares", "bonds",
        "etf", "portfolio", "personal finance",
    ],
    "social_opinion": [
        "i think", "my take", "hot take", "thread", "opinion", "thoughts", "reaction", "讨论", "观点",
        "吐槽", "随想",
    ],
    "product_launch": [
        "launch", "launched", "introducing", "show hn", "beta", "waitlist", "上线", "发布",
    ],
    "generic_media": [
        "tutorial", "course", "lesson", "walkthrough", "beginner", "intro", "getting started",
        "productivity routines", "startup lessons", "paper club", "recap", "interview",
    ],
    "keyword_stop_latin": [
        "today", "headlines", "summary", "platform", "statistics", "developer", "tools", "research",
        "social", "community", "books", "reading", "the", "and", "for", "with", "from", "that", "this",
        "are", "was", "you", "your", "data", "raw", "unavailable", "http", "https", "www", "link",
        "links", "com", "org", "net", "can", "have", "has", "had", "more", "most", "less", "but",
        "not", "all", "new", "use", "using", "used", "into", "over", "under", "than", "their", "them",
        "they", "will", "would", "about", "after", "before", "across", "through", "during",
        "localllama", "reddit", "github", "zhihu", "producthunt", "anthropic", "openai", "google",
        "twitter", "xiaoyuzhou", "podcast", "technology", "like", "our", "now", "just", "what", "amp",
        "paper", "papers", "post", "posts", "thread", "threads",
    ],
    "keyword_stop_cjk": [
        "平台", "统计", "摘要", "主题", "内容", "链接", "本期", "本月", "本周", "来源", "数据", "原始", "继续", "调研", "值得", "核心",
        "观察", "讨论", "发布",
    ],
    "keyword_generic": [
        "model", "models", "agent", "agents", "code", "work", "one", "out", "been", "how", "tool",
        "tools", "app", "apps", "ai", "pro", "release", "preview",
    ],
    "entity_stop": [
        "Pro", "Release", "Preview", "Desktop", "Studio", "Word", "Managed", "Agents",
    ],
    "report_stop": [
        "today", "headlines", "platform", "statistics", "summary", "research", "developer", "tools",
        "videos", "podcasts", "social", "community", "books", "reading", "the", "and", "for", "with",
        "from", "this", "that", "will", "more", "most", "less", "have", "has", "had", "data", "report",
        "daily", "weekly", "monthly", "quarterly", "semiannual", "annual", "models", "model", "agents",
        "agent", "release", "preview", "status", "github", "reddit", "twitter", "producthunt", "https",
        "http", "www", "top", "papers", "paper", "link", "links", "本周期", "本周", "本月", "本季", "半年", "全年",
        "观察", "继续", "调研", "平台", "统计", "日报", "周报", "月报", "季报", "年报", "案例", "原文", "链接", "入口", "建议", "精读",
        "AI", "LLM",
    ],
    "cluster_generic": [
        "ai", "llm", "llms", "model", "models", "agent", "agents", "code", "coding", "api", "app",
        "apps", "launch", "launching", "introducing", "new", "update", "updates", "release", "today",
        "official", "blog", "news", "research", "paper", "message", "messages", "context", "usage",
        "available", "read", "breakthrough", "signal", "signals", "long", "sentence", "unique",
        "payload", "developer", "developers", "tool", "tools", "finance", "market", "markets",
        "openai", "anthropic", "claude", "chatgpt", "gpt", "google", "gemini", "deepmind", "microsoft",
        "github", "meta", "llama", "nvidia", "apple", "x_twitter", "twitter", "reddit", "hackernews",
        "youtube", "alphaxiv", "huggingface", "framework", "frameworks", "machine", "learning",
        "training", "inference",
    ],
}

# Topic keywords, in topic order.
TOPIC_KEYWORDS: dict[str, list[str]] = {
    "AI Models & Agent": [
        "ai", "llm", "llms", "model", "models", "agent", "agents", "agentic", "openai", "anthropic",
        "claude", "chatgpt", "gpt", "gemini", "deepseek", "kimi", "moonshot", "glm", "zhipu",
        "minimax", "xai", "grok", "llama", "meta", "thinking machines", "thinking machine", "cursor",
        "multimodal", "reasoning", "alignment", "eval", "benchmark", "大模型", "模型升级", "版本升级", "超长上下文",
        "多模态",
    ],
    "Developer Tools": [
        "github", "release", "sdk", "api", "cli", "code", "coding", "developer", "devtools", "runtime",
        "library", "framework", "plugin", "workflow", "mcp", "copilot", "cursor", "codex", "opencode",
        "ollama", "skill", "skills", "tool use", "function calling", "ai assistant", "ai assistants",
        "开放平台", "开放能力", "服务调用", "一句话下单", "跑腿", "real-world service",
    ],
    "Infrastructure & Systems": [
        "infra", "infrastructure", "server", "servers", "gpu", "cuda", "h100", "h200", "blackwell",
        "datacenter", "data", "center", "cloud", "deployment", "deploy", "inference", "serving",
        "latency", "throughput", "kernel", "storage",
    ],
    "Research Papers": [
        "paper", "papers", "arxiv", "openreview", "research", "benchmark", "dataset", "method",
        "technical", "report", "study", "towards", "evaluating",
    ],
    "Finance & Markets": [
        "stock", "market", "earnings", "revenue", "funding", "valuation", "shares", "nasdaq", "sec",
        "guidance", "forecast", "tariff",
    ],
    "Videos & Podcasts": [
        "youtube", "podcast", "video", "episode", "interview", "course",
    ],
    "Books & Reading": [
        "book", "books", "reading", "kindle", "weread", "douban",
    ],
    "Social & Community": [
        "community", "reddit", "twitter", "x", "hackernews", "hn", "discussion",
    ],
}

"""Declared schemas: nothing is inferred on the way in."""

PAPER = """paperId string, corpusId bigint, title string, abstract string, venue string, year int, publicationDate string, citationCount int, isOpenAccess boolean, url string,
publicationTypes array<string>, authors array<struct<authorId:string,name:string>>, externalIds map<string,string>, openAccessPdf struct<url:string,license:string,status:string>,
publicationVenue struct<name:string,alternate_names:array<string>>"""
QUERY = "id string, cat_pos int, query string, params map<string,string>"
EDGE = "seed string, edge_type string, pos bigint, is_influential boolean, intents array<string>, contexts array<string>, paper struct<paperId:string,title:string,year:int,publicationDate:string,citationCount:int,externalIds:map<string,string>>"
WORK = """crossref struct<DOI:string,type:string,subtype:string,title:string,container_title:string,issue:string,update_to:array<string>,online:array<int>,published:array<int>,issued:array<int>>,
openalex struct<type:string,display_name:string,is_paratext:boolean,is_retracted:boolean>"""
PAYLOAD = "paper_key string, provider string, lookup_kind string, lookup_key string, hit_pos int, payload string, status int, error string"
ATTEMPT = "paper_key string, round int, rank int, source_name string, pdf_url string, final_url string, status string, error string, http_status int, not_a_pdf boolean, wrong_document boolean, host_blocked boolean, host_denied boolean, host_challenged boolean, host string"
RUN = "run_id string, label string, started_at string, completed_at string, status string, counts map<string,struct<raw:bigint,final:bigint>>"
PAGE = "page_id bigint, url string, final_url string, status int, headers map<string,string>, publisher string, html string"
RESULT = "paper_key string, original_paper_key string, semantic_scholar_id string, title string, status string, downloaded boolean, reused_existing boolean, pdf_path string, version_type string, source_name string"
